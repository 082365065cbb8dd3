"""Browsing-style segments: A04 session_browsing_style, A12 summary, A13 deep
specialists, A14 variety seekers, A37 segment coverage, A48 segment lookup.

Everything reads the session-level features (one row per session); the
per-segment results have as many rows as there are segment labels, so the
share-of-total window over them is a window over at most a handful of rows.
Quantiles are exact (``percentile_disc``: a value-count map per group, merged
map-side, bounded by the distinct item counts, not by sessions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.rules import contains_cs, fold_cases

# Style labels and the segment bucket labels of the reference marts.
LIGHT = "Light Browser"
DEEP = "Deep Specialist (한우물형)"
VARIETY = "Variety Seeker (다양성 추구형)"
OTHERS = "Others"
DEPTH_SEGMENTS = ["1. 탐색 초기 (3-11개)", "2. 집중 비교 (12-24개)", "3. 고민 심화 (25-36개)", "4. 결정 마비 (37개 이상)"]
INTENSITY_SEGMENTS = ["1. Light Seeker (24개 이하)", "2. Moderate Seeker (25-36개)",
                      "3. Heavy Seeker (37-84개)", "4. Super Heavy Seeker (85개 이상)"]
QUANTILES = [25, 50, 75, 90, 100]


def browsing_style(sessions: DataFrame, light_max_items: int = 2) -> DataFrame:
    """Sessions with at least one viewed item and their style."""
    items = F.col("total_items_viewed")
    cats = F.col("distinct_categories_viewed")
    style = fold_cases([
        (items <= light_max_items, LIGHT),
        ((items > light_max_items) & (cats == 1), DEEP),
        (cats >= 2, VARIETY),
    ], OTHERS)
    return (sessions
            .select("session_unique_id",
                    F.size("viewed_categories").cast("bigint").alias("distinct_categories_viewed"),
                    F.col("total_items_viewed").cast("bigint").alias("total_items_viewed"),
                    F.col("has_purchase").alias("is_converted"))
            .filter(F.col("total_items_viewed") > 0)
            .select("session_unique_id", "distinct_categories_viewed", "total_items_viewed",
                    "is_converted", style.alias("browsing_style")))


def _share(count_col: str, digits: int = 1):
    total = F.sum(count_col).over(Window.partitionBy(F.lit(1)))
    return F.round(F.col(count_col) * F.lit(100.0) / total, digits)


def browsing_style_summary(styles: DataFrame, quantiles=QUANTILES, approx: bool = False,
                           accuracy: int = 100000) -> DataFrame:
    """Per style sessions, share %, average and quantiles of items viewed, CVR %.

    Quantiles are exact discrete percentiles by default (an element of the
    data, like the reference's approximate ones); ``approx=True`` uses the
    mergeable sketch ``percentile_approx`` at ``accuracy``."""
    def q(k):
        if approx:
            return F.percentile_approx("total_items_viewed", k / 100, accuracy).cast("double")
        return F.expr(f"percentile_disc({k / 100}) WITHIN GROUP (ORDER BY total_items_viewed)")
    q_cols = [F.round(q(k), 3).alias(f"item_viewed_p{k}") for k in quantiles]
    agg = styles.groupBy("browsing_style").agg(
        F.count("session_unique_id").alias("session_count"),
        F.round(F.avg("total_items_viewed"), 3).alias("avg_items_viewed"),
        *q_cols,
        F.round(F.avg("is_converted") * F.lit(100.0), 3).alias("conversion_rate"),
    )
    return agg.select("browsing_style", "session_count",
                      _share("session_count").alias("session_share_percent"),
                      "avg_items_viewed", *[f"item_viewed_p{k}" for k in quantiles], "conversion_rate")


def depth_bucket(items):
    return fold_cases([
        (items < 12, DEPTH_SEGMENTS[0]),
        (items.between(12, 24), DEPTH_SEGMENTS[1]),
        (items.between(25, 36), DEPTH_SEGMENTS[2]),
        (items > 36, DEPTH_SEGMENTS[3]),
    ], OTHERS)


def intensity_bucket(items):
    return fold_cases([
        (items <= 24, INTENSITY_SEGMENTS[0]),
        (items.between(25, 36), INTENSITY_SEGMENTS[1]),
        (items.between(37, 84), INTENSITY_SEGMENTS[2]),
        (items > 84, INTENSITY_SEGMENTS[3]),
    ], OTHERS)


def deep_specialists(styles: DataFrame) -> DataFrame:
    """Depth buckets of Deep Specialist sessions."""
    agg = (styles.filter(F.col("browsing_style") == DEEP)
           .groupBy(depth_bucket(F.col("total_items_viewed")).alias("depth_segment"))
           .agg(F.count("session_unique_id").alias("session_count"),
                F.round(F.avg("total_items_viewed"), 1).alias("avg_views"),
                F.round(F.avg("is_converted") * F.lit(100.0), 2).alias("conversion_rate")))
    return agg.select("depth_segment", "session_count", _share("session_count").alias("share_percent"),
                      "avg_views", "conversion_rate")


def variety_seekers(styles: DataFrame) -> DataFrame:
    """Intensity buckets of Variety Seeker sessions."""
    agg = (styles.filter(F.col("browsing_style") == VARIETY)
           .groupBy(intensity_bucket(F.col("total_items_viewed")).alias("intensity_segment"))
           .agg(F.count("session_unique_id").alias("session_count"),
                F.round(F.avg("total_items_viewed"), 1).alias("avg_total_views"),
                F.round(F.avg("distinct_categories_viewed"), 1).alias("avg_categories"),
                F.round(F.avg("is_converted") * F.lit(100.0), 2).alias("conversion_rate")))
    return agg.select("intensity_segment", "session_count", _share("session_count").alias("share_percent"),
                      "avg_total_views", "avg_categories", "conversion_rate")


def segment_coverage(sessions: DataFrame) -> DataFrame:
    """Sessions that have a browsing style / all sessions, in percent.

    The style mart counts session ids, so the NULL session is in no segment;
    it is one of all sessions."""
    return sessions.agg(
        F.count(F.when(F.col("total_items_viewed") > 0, F.col("session_unique_id"))).alias("segment_sessions"),
        F.count(F.lit(1)).alias("total_sessions"),
    ).select("segment_sessions", "total_sessions",
             (F.try_divide(F.col("segment_sessions").cast("double"), F.col("total_sessions").cast("double"))
              * F.lit(100.0)).alias("coverage_percent"))


def segment_lookup(df: DataFrame, label_col: str, pattern: str, regex: bool = False) -> DataFrame:
    """Rows whose label contains ``pattern`` (substring, or regex when ``regex``)."""
    cond = F.coalesce(F.col(label_col).rlike(pattern), F.lit(False)) if regex else contains_cs(F.col(label_col), pattern)
    return df.filter(cond)
