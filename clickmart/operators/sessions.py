"""Session-level models: the fused session aggregate (survey P1), A02
session_funnel and A03 session_paths.

``session_features`` groups the staged rows once, by (session, user), and
computes every session fact the marts need: dimensions, times, funnel flags,
the lift score, item/category counts, revenue.  Catalyst prunes the aggregate
expressions a given mart does not reference, so each mart pays only for what
it reads, and a pipeline that persists the features pays one shuffle for all.
All aggregates are partial (map-side) except the category set, which is
bounded by the category taxonomy, so a hot session costs no more than a cold
one before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, flag

# Event names of the funnel flags.
FUNNEL_FLAGS = [
    ("has_session_start", "session_start"),
    ("has_view_item", "view_item"),
    ("has_add_to_cart", "add_to_cart"),
    ("has_begin_checkout", "begin_checkout"),
    ("has_add_payment_info", "add_payment_info"),
    ("has_purchase", "purchase"),
]
# Lift weights of the engagement score (rounded lifts), other events weigh 1.
SCORE_WEIGHTS = {
    "view_item": 5,
    "view_search_results": 3,
    "add_to_cart": 12,
    "begin_checkout": 31,
    "add_payment_info": 47,
}
# The short score shown on the method page (no search weight).
SHORT_SCORE_WEIGHTS = {
    "view_item": 5,
    "add_to_cart": 12,
    "begin_checkout": 31,
    "add_payment_info": 47,
}
DEFAULT_WEIGHT = 1
PATH_SEPARATOR = " > "
SESSION = "session_unique_id"


def path_expr(separator: str = PATH_SEPARATOR) -> Column:
    """Event names joined in time order (``event_id`` breaks timestamp ties)."""
    sep = separator.replace("'", "''")
    return F.expr(f"listagg(event_name, '{sep}') WITHIN GROUP (ORDER BY event_timestamp, event_id)")


def weight_expr(weights: dict[str, int], default: int = DEFAULT_WEIGHT) -> Column:
    return fold_cases([(F.col("event_name") == e, w) for e, w in weights.items()], default)


def session_features(stg: DataFrame, weights: dict[str, int] | None = None,
                     short_weights: dict[str, int] | None = None) -> DataFrame:
    """One row per (session_unique_id, user_pseudo_id) of the staged rows.

    The ordered path string is not part of it (``session_paths``): it is the
    one session output whose size grows with the session."""
    weights = SCORE_WEIGHTS if weights is None else weights
    short_weights = SHORT_SCORE_WEIGHTS if short_weights is None else short_weights
    ev = F.col("event_name")
    ts = F.col("event_timestamp")
    flags = [F.max(flag(ev == name)).alias(col) for col, name in FUNNEL_FLAGS]
    return stg.groupBy(SESSION, "user_pseudo_id").agg(
        F.max("session_source").alias("session_source"),
        F.max("session_medium").alias("session_medium"),
        F.max("session_campaign").alias("session_campaign"),
        F.max("device_category").alias("device_category"),
        F.max("is_member").alias("is_member"),
        F.min(ts).alias("session_start_at"),
        F.min(F.hour(ts)).alias("session_hour"),
        F.min(F.dayofweek(ts)).alias("session_day_of_week"),
        *flags,
        F.max(flag(ev == "view_search_results")).alias("has_search"),
        F.max("purchase_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("path_length"),
        F.sum(weight_expr(weights)).cast("bigint").alias("engagement_score"),
        F.sum(weight_expr(short_weights)).cast("bigint").alias("engagement_score_short"),
        F.count(F.when(ev == "view_item", F.col("item_name"))).alias("total_items_viewed"),
        F.collect_set(F.when(ev == "view_item", F.col("item_category"))).alias("viewed_categories"),
        F.max(F.when(ev == "purchase", ts)).alias("purchased_at"),
        F.sum("item_revenue_calc").alias("total_revenue"),
    )


# How each feature merges when several (NULL session, user) groups form the one
# NULL session of the session-level models.
_MERGE = {
    "session_source": F.max, "session_medium": F.max, "session_campaign": F.max,
    "device_category": F.max, "is_member": F.max, "session_start_at": F.min,
    "session_hour": F.min, "session_day_of_week": F.min, "revenue": F.max,
    "purchased_at": F.max, "path_length": F.sum, "engagement_score": F.sum,
    "engagement_score_short": F.sum, "total_items_viewed": F.sum, "total_revenue": F.sum,
}


def session_level(features: DataFrame) -> DataFrame:
    """Features at session grain: the reference groups by session only, so all
    rows with a NULL session form one session.  Non-NULL sessions pass through;
    only the NULL part is re-aggregated, into at most one row.  This assumes
    that a session id has one user, which holds for ids made by A01 (the user
    and the number after the last dash); other sources must keep to it.

    That part may be large (one key can hold many users' rows), so its merge is
    partial throughout.  Its category set is a scalar subquery over the
    exploded categories (de-duplicated map-side, bounded by the category
    taxonomy); a query that does not read the categories prunes it."""
    flag_cols = [c for c, _ in FUNNEL_FLAGS] + ["has_search"]
    keyed = features.filter(F.col(SESSION).isNotNull()).drop("user_pseudo_id")
    nulls = features.filter(F.col(SESSION).isNull())
    aggs = []
    for c in keyed.columns:
        if c in (SESSION, "viewed_categories"):
            continue
        if c in flag_cols:
            aggs.append(F.max(c).alias(c))
        elif c in _MERGE:
            aggs.append(_MERGE[c](c).alias(c))
        else:
            aggs.append(F.max(c).alias(c))
    merged = nulls.groupBy(SESSION).agg(*aggs)
    if "viewed_categories" in keyed.columns:
        categories = nulls.select(F.explode("viewed_categories").alias("_cat")) \
            .agg(F.collect_set("_cat").alias("viewed_categories"))
        merged = merged.withColumn("viewed_categories", categories.scalar())
    return keyed.unionByName(merged.select(*keyed.columns))


def session_funnel(stg: DataFrame = None, *, sessions: DataFrame | None = None) -> DataFrame:
    """One row per session with dimensions, start, min hour/weekday (Q3),
    funnel flags and revenue."""
    s = sessions if sessions is not None else session_level(session_features(stg))
    return s.select(
        SESSION, "session_source", "session_medium", "session_campaign", "device_category",
        "is_member", "session_start_at", "session_hour", "session_day_of_week",
        *[c for c, _ in FUNNEL_FLAGS], "revenue",
    )


def session_path_pieces(stg: DataFrame, separator: str = PATH_SEPARATOR, max_rows: int = 20_000) -> DataFrame:
    """Paths in pieces of time: session, piece (its start), path, rows, conversion flag.

    A piece is an hour of a session; an hour of more than ``max_rows`` rows is
    cut into as many equal parts as that takes, so a bot's hour, or that of
    the NULL session (all events without an id), is ordered by many tasks.
    Equal timestamps always share a piece.  This is the scale-safe form of A03:
    no row of it grows with the length of a session."""
    ts = F.col("event_timestamp")
    hour = F.date_trunc("hour", ts)
    timed = stg.withColumn("_hour", hour)
    busy = (timed.groupBy(SESSION, "_hour").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows)
            .select(F.col(SESSION).alias("_busy"), F.col("_hour").alias("_busy_hour"),
                    (F.lit(3_600_000_000) / F.ceil(F.col("_rows") / max_rows)).cast("long").alias("_width")))
    cut = timed.join(busy, timed[SESSION].eqNullSafe(busy["_busy"]) & (timed["_hour"] == busy["_busy_hour"]), "left")
    into = F.unix_micros(ts) - F.unix_micros("_hour")
    width = F.coalesce("_width", F.lit(3_600_000_000).cast("long"))
    piece = F.timestamp_micros(F.unix_micros("_hour") + into - F.pmod(into, width))
    return cut.groupBy(SESSION, piece.alias("piece")).agg(
        path_expr(separator).alias("path"), F.count(F.lit(1)).alias("path_length"),
        F.max(flag(F.col("action_type") == "Purchase")).alias("is_converted"))


def session_paths(stg: DataFrame, separator: str = PATH_SEPARATOR, max_rows: int = 20_000) -> DataFrame:
    """Ordered event path per session, its length and conversion flag.

    Ties on the timestamp are broken by ``event_id`` so the string is
    deterministic.  Events are ordered in pieces (``session_path_pieces``),
    which are then joined in time order; the result equals a single ordered
    aggregation.  The whole path is one string by definition: a session of
    more than about 2 GB of event names cannot be one row, and its path is
    only to be had in pieces.
    """
    sep = separator.replace("'", "''")
    return session_path_pieces(stg, separator, max_rows).groupBy(SESSION).agg(
        F.expr(f"listagg(path, '{sep}') WITHIN GROUP (ORDER BY piece)").alias("full_path"),
        F.sum("path_length").alias("path_length"),
        F.max("is_converted").alias("is_converted"),
    )
