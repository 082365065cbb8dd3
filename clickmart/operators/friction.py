"""A23 device_friction and A26 time_to_conversion.

A23 in the reference joins every staged row to the score and path tables only
to count rows per device (Q1: "users" are item rows).  Here the staged rows are
first reduced to (device, session, rows) with a partial aggregate, then joined
to one row of session facts each; the weighted sums give the same integers
with a join input of sessions instead of events (survey P4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, pct, safe_div
from clickmart.operators.scoring import graded_sessions
from clickmart.operators.sessions import SESSION

BASELINE_DEVICE = "desktop"
HIGH = "High Intent"
# Purchase-time buckets (upper bounds in minutes) and their labels.
TIME_BUCKETS = [(5, "0-5분 (즉시 구매)"), (15, "5-15분 (단기 탐색)"), (30, "15-30분 (중기 탐색)"),
                (60, "30-60분 (장기 고민)")]
TIME_BUCKET_LAST = "60분 이상"


def device_friction(stg: DataFrame, features: DataFrame, grain: str = "event",
                    baseline: str = BASELINE_DEVICE, scores: DataFrame | None = None) -> DataFrame:
    """Sessions, High-Intent count, ratio %, High-Intent CVR %, index vs baseline = 100.

    ``grain='event'`` counts staged rows as the reference does (Q1);
    ``grain='session'`` counts sessions."""
    per = stg.groupBy("device_category", SESSION).agg(F.count(F.lit(1)).alias("n"))
    joined = per.join(graded_sessions(features, scores), SESSION, "inner")
    w = F.col("n") if grain == "event" else F.lit(1).cast("bigint")
    high = F.col("engagement_grade") == HIGH
    stats = joined.groupBy("device_category").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.coalesce(F.sum(F.when(high, w)), F.lit(0)).cast("bigint").alias("high_intent_users"),
        F.coalesce(F.sum(F.when(high & (F.col("has_purchase") == 1), w)), F.lit(0)).cast("bigint")
        .alias("high_intent_converters"),
    ).filter(F.col("high_intent_users") > 0)
    cvr = safe_div(F.col("high_intent_converters"), F.col("high_intent_users"))
    stats = stats.withColumn("high_intent_cvr", cvr)
    base = F.max(F.when(F.col("device_category") == baseline, F.col("high_intent_cvr"))) \
        .over(Window.partitionBy(F.lit(1)))  # one row per device category
    return stats.select(
        "device_category", "total_sessions", "high_intent_users",
        F.round(pct(F.col("high_intent_users"), F.col("total_sessions")), 1).alias("high_intent_ratio"),
        F.round(F.col("high_intent_cvr") * F.lit(100.0), 1).alias("high_intent_cvr_percent"),
        F.round(F.try_divide(F.col("high_intent_cvr"), base) * F.lit(100.0), 0).alias("efficiency_index_vs_pc"),
    )


def time_to_conversion(sessions: DataFrame) -> DataFrame:
    """Whole minutes from session start to the last purchase, bucket,
    sessions and average session value (all item revenue of the session)."""
    bought = sessions.filter(F.col("has_purchase") == 1)
    minutes = F.expr("timestampdiff(MINUTE, session_start_at, purchased_at)")
    bucket = fold_cases([(F.col("minutes_to_buy") < b, label) for b, label in TIME_BUCKETS], TIME_BUCKET_LAST)
    return (bought.select(minutes.alias("minutes_to_buy"), "total_revenue")
            .groupBy("minutes_to_buy", bucket.alias("time_bucket"))
            .agg(F.count(F.lit(1)).alias("session_count"),
                 F.round(F.avg("total_revenue"), 1).alias("avg_order_value")))
