"""Funnel marts A15-A22 and the KPI summary A36.

All of them read session rows (A02 output or the session-level features),
never the event rows, except A22 which the reference defines on events and
which we also answer from session flags (survey P2: distinct sessions per
step = sum of per-session flags, no COUNT(DISTINCT) expansion).  Global
aggregates produce one row; the unpivots are a single ``stack`` over that row
instead of a UNION ALL re-scan per branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, pct, safe_div

# Drop-off step labels, weekday labels, sankey stages, open-funnel steps.
DROPOFF_STEPS = [
    (1, "Session → View Item", "total_sessions", "viewed"),
    (2, "View Item → Add to Cart", "viewed", "carted"),
    (3, "Add to Cart → Begin Checkout", "carted", "checkout"),
    (4, "Begin Checkout → Add Payment", "checkout", "payment"),
    (5, "Add Payment → Purchase", "payment", "purchased"),
]
DAY_NAMES = {1: "일요일", 2: "월요일", 3: "화요일", 4: "수요일", 5: "목요일", 6: "금요일", 7: "토요일"}
SANKEY_STAGES = [
    ("has_purchase", "5_Purchased"),
    ("has_add_payment_info", "4_Dropped_Payment"),
    ("has_begin_checkout", "3_Dropped_Checkout"),
    ("has_add_to_cart", "2_Dropped_Cart"),
    ("has_view_item", "1_Dropped_View"),
]
SANKEY_DEFAULT = "0_No_View"
OPEN_FUNNEL_STEPS = [
    (1, "1. Session Start", "sessions"),
    (2, "2. View Product", "has_view_item"),
    (3, "3. Add to Cart", "has_add_to_cart"),
    (4, "4. Purchase", "has_purchase"),
]
DIRECT_SOURCE = "(direct)"
NO_MEDIUM = "(none)"


def _round_pct(num, den, digits=2):
    return F.round(pct(num, den), digits)


def funnel_overall(sessions: DataFrame) -> DataFrame:
    """One row of step counts and percentages."""
    n = F.count(F.lit(1))
    return sessions.agg(
        n.alias("total_sessions"),
        F.sum("has_view_item").cast("bigint").alias("step1_view_item"),
        F.sum("has_add_to_cart").cast("bigint").alias("step2_add_to_cart"),
        F.sum("has_begin_checkout").cast("bigint").alias("step3_begin_checkout"),
        F.sum("has_add_payment_info").cast("bigint").alias("step4_add_payment_info"),
        F.sum("has_purchase").cast("bigint").alias("step5_purchase"),
        _round_pct(F.sum("has_view_item"), n).alias("pct_view"),
        _round_pct(F.sum("has_add_to_cart"), n).alias("pct_cart"),
        _round_pct(F.sum("has_purchase"), n).alias("pct_purchase"),
    )


def funnel_dropoff(sessions: DataFrame) -> DataFrame:
    """Five step-to-step rows from one global aggregate."""
    counts = sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("has_view_item").cast("bigint").alias("viewed"),
        F.sum("has_add_to_cart").cast("bigint").alias("carted"),
        F.sum("has_begin_checkout").cast("bigint").alias("checkout"),
        F.sum("has_add_payment_info").cast("bigint").alias("payment"),
        F.sum("has_purchase").cast("bigint").alias("purchased"),
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(order).alias("step_order"), F.lit(label).alias("step"),
                 F.col(a).alias("from_count"), F.col(b).alias("to_count"),
                 F.round(pct(F.col(a) - F.col(b), F.col(a)), 2).alias("drop_rate"))
        for order, label, a, b in DROPOFF_STEPS
    ]))
    return counts.select(rows.alias("r")).select("r.*")


def funnel_device(sessions: DataFrame) -> DataFrame:
    """Per device sessions, step counts, CVR and view-to-cart."""
    n = F.count(F.lit(1))
    return sessions.groupBy("device_category").agg(
        n.alias("sessions"),
        F.sum("has_view_item").cast("bigint").alias("viewed"),
        F.sum("has_add_to_cart").cast("bigint").alias("carted"),
        F.sum("has_purchase").cast("bigint").alias("purchased"),
        _round_pct(F.sum("has_purchase"), n).alias("overall_cvr"),
        _round_pct(F.sum("has_add_to_cart"), F.sum("has_view_item")).alias("view_to_cart"),
    )


def _by_key(sessions: DataFrame, key: str) -> DataFrame:
    n = F.count(F.lit(1))
    return sessions.groupBy(key).agg(
        n.alias("sessions"),
        F.sum("has_purchase").cast("bigint").alias("purchased"),
        _round_pct(F.sum("has_purchase"), n).alias("cvr"),
    )


def funnel_day(sessions: DataFrame, day_names: dict[int, str] | None = None) -> DataFrame:
    """Per weekday (1 = Sunday, min over the session, Q3) with its label."""
    names = DAY_NAMES if day_names is None else day_names
    label = fold_cases([(F.col("session_day") == d, name) for d, name in names.items()])
    agg = _by_key(sessions.withColumnRenamed("session_day_of_week", "session_day"), "session_day")
    return agg.select("session_day", label.alias("day_name"), "sessions", "purchased", "cvr")


def funnel_hour(sessions: DataFrame) -> DataFrame:
    """Per session hour (min hour of the session, Q3)."""
    return _by_key(sessions, "session_hour")


def funnel_source(sessions: DataFrame, min_sessions: int = 50, top_n: int = 20) -> DataFrame:
    """Per source/medium with defaults, at least ``min_sessions``, top ``top_n``
    by sessions (ties by source, medium)."""
    n = F.count(F.lit(1))
    keyed = sessions.select(
        F.coalesce("session_source", F.lit(DIRECT_SOURCE)).alias("source"),
        F.coalesce("session_medium", F.lit(NO_MEDIUM)).alias("medium"),
        "has_purchase",
    )
    agg = keyed.groupBy("source", "medium").agg(
        n.alias("sessions"),
        F.sum("has_purchase").cast("bigint").alias("purchased"),
        _round_pct(F.sum("has_purchase"), n).alias("cvr"),
    ).filter(F.col("sessions") >= min_sessions)
    return agg.orderBy(F.desc("sessions"), "source", "medium").limit(top_n)


def funnel_sankey(sessions: DataFrame) -> DataFrame:
    """Sessions per furthest stage (first matching flag from the bottom)."""
    stage = fold_cases([(F.col(c) == 1, label) for c, label in SANKEY_STAGES], SANKEY_DEFAULT)
    return sessions.groupBy(stage.alias("final_stage")).agg(F.count(F.lit(1)).alias("session_count"))


def open_funnel(sessions: DataFrame) -> DataFrame:
    """Distinct non-NULL sessions per step, step conversion and drop-off.

    COUNT(DISTINCT session) ignores the NULL session, so it is excluded here."""
    keyed = sessions.filter(F.col("session_unique_id").isNotNull())
    counts = keyed.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("has_view_item").cast("bigint").alias("has_view_item"),
        F.sum("has_add_to_cart").cast("bigint").alias("has_add_to_cart"),
        F.sum("has_purchase").cast("bigint").alias("has_purchase"),
    )
    structs = []
    prev = None
    for order, name, col in OPEN_FUNNEL_STEPS:
        cnt = F.coalesce(F.col(col), F.lit(0)).cast("bigint")
        if prev is None:
            conv, drop = F.lit(1.0), F.lit(0.0)
        else:
            ratio = safe_div(cnt, F.coalesce(F.col(prev), F.lit(0)))
            conv, drop = F.round(ratio, 4), F.round(F.lit(1.0) - ratio, 4)
        structs.append(F.struct(F.lit(name).alias("step_name"), F.lit(order).alias("step_order"),
                                cnt.alias("user_count"), conv.alias("conversion_rate"),
                                drop.alias("drop_off_rate")))
        prev = col
    return counts.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def kpi_summary(funnel_overall_df: DataFrame) -> DataFrame:
    """Sessions, purchases, CVR %, bounce % = (1 - p/s)·100, cart-add rate % (1 place)."""
    s = F.col("total_sessions")
    p = F.col("step5_purchase")
    return funnel_overall_df.select(
        s.alias("total_sessions"),
        p.alias("total_purchases"),
        F.col("pct_purchase").alias("overall_cvr"),
        ((F.lit(1.0) - safe_div(p, s)) * F.lit(100.0)).alias("bounce_rate"),
        (safe_div(p, s) * F.lit(100.0)).alias("cvr_rate"),
        F.round(safe_div(F.col("step2_add_to_cart"), s) * F.lit(100.0), 1).alias("cart_add_rate"),
    )
