"""Sources and sinks (A52): partitioned event exports, mart tables, CSV.

* Event exports are parquet datasets partitioned by ``event_date``
  (``YYYYMMDD``, one folder per daily shard); a date range on that column is
  partition pruning, the equivalent of the reference's shard-suffix range.
* Marts are written as parquet (the main sink) and optionally as header CSV,
  the format the reference exports; reading CSV uses an explicit schema, and
  marts that are absent are skipped, as the reference's loader does.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schemas import NESTED_EVENT

# Column types of the exported marts that the dashboard statistics read.
MART_SCHEMAS: dict[str, str] = {
    "browsing_style": ("browsing_style string, session_count long, session_share_percent double, "
                       "avg_items_viewed double, item_viewed_p25 double, item_viewed_p50 double, "
                       "item_viewed_p75 double, item_viewed_p90 double, item_viewed_p100 double, "
                       "conversion_rate double"),
    "cart_abandon": ("item_name string, item_category string, abandoned_session_count long, "
                     "total_lost_revenue double, avg_lost_value double"),
    "deep_specialists": "depth_segment string, session_count long, share_percent double, avg_views double, "
                        "conversion_rate double",
    "variety_seekers": "intensity_segment string, session_count long, share_percent double, "
                       "avg_total_views double, avg_categories double, conversion_rate double",
    "device_friction": "device_category string, total_sessions long, high_intent_users long, "
                       "high_intent_ratio double, high_intent_cvr_percent double, efficiency_index_vs_pc double",
    "funnel_overall": "total_sessions long, step1_view_item long, step2_add_to_cart long, "
                      "step3_begin_checkout long, step4_add_payment_info long, step5_purchase long, "
                      "pct_view double, pct_cart double, pct_purchase double",
    "funnel_dropoff": "step_order int, step string, from_count long, to_count long, drop_rate double",
    "funnel_device": "device_category string, sessions long, viewed long, carted long, purchased long, "
                     "overall_cvr double, view_to_cart double",
    "funnel_day": "session_day int, day_name string, sessions long, purchased long, cvr double",
    "funnel_hour": "session_hour int, sessions long, purchased long, cvr double",
    "funnel_source": "source string, medium string, sessions long, purchased long, cvr double",
    "promo_quality": "promotion_name string, ctr_percent double, click_sessions long, avg_session_score double, "
                     "high_intent_session_count long, promo_cvr double, promo_status string",
    "time_to_conversion": "minutes_to_buy long, time_bucket string, session_count long, avg_order_value double",
    "bundle_strategy": "product_A string, price_A double, tier_A string, product_B string, price_B double, tier_B string, "
                       "pair_sales_count long, avg_buyer_score double, high_intent_ratio double, bundle_strategy_type string",
    "core_sessions": "session_unique_id string, user_pseudo_id string, engagement_grade string, engagement_score long, "
                     "full_path string, path_length long, is_converted int, is_missed_opportunity boolean",
}


def read_events(spark: SparkSession, path: str, start_date: str | None = None,
                end_date: str | None = None) -> DataFrame:
    """Nested event export partitioned by ``event_date``; the range prunes partitions.

    The partition value is kept as a string (``20201201`` is a date label)."""
    schema = T.StructType([f for f in NESTED_EVENT.fields])
    df = spark.read.schema(schema).parquet(path)
    if start_date is not None:
        df = df.filter(F.col("event_date") >= start_date)
    if end_date is not None:
        df = df.filter(F.col("event_date") <= end_date)
    return df


def shard_dates(spark: SparkSession, path: str) -> list[str]:
    """Dates of an export's daily shards in order, from the names of its folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = [f.getPath().getName().partition("=") for f in found]
    return sorted(value for column, _, value in names if column == "event_date")


def write_events(df: DataFrame, path: str) -> None:
    """Write (or re-write) daily shards: dynamic overwrite replaces only the dates present."""
    (df.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(path))


def write_staged(stg: DataFrame, path: str, daily: bool = False) -> None:
    """Staged rows partitioned by ``event_date`` and sorted by ``event_name`` within a file.

    A full refresh by default; ``daily`` replaces only the dates present."""
    (stg.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event_name").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if daily else "static").partitionBy("event_date").parquet(path))


def write_mart(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Full-refresh sink of one mart.  ``single_file`` is meant for the small
    per-segment marts only (it funnels the result through one task)."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_marts(marts: Mapping[str, DataFrame], base: str, fmt: str = "parquet",
                small: Iterable[str] = ()) -> dict[str, str]:
    small = set(small)
    paths = {}
    for name, df in marts.items():
        paths[name] = f"{base.rstrip('/')}/{name}"
        write_mart(df, paths[name], fmt, single_file=name in small)
    return paths


def read_mart_csv(spark: SparkSession, path: str, name: str | None = None, schema: str | None = None) -> DataFrame:
    """Header CSV of a mart with its declared schema (no inference)."""
    ddl = schema or (MART_SCHEMAS.get(name) if name else None)
    reader = spark.read.option("header", True)
    if ddl:
        reader = reader.schema(ddl)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def load_marts(spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv") -> dict[str, DataFrame]:
    """Load the marts that exist; a missing path is skipped, any other failure is raised."""
    out = {}
    for name, path in paths.items():
        try:
            df = read_mart_csv(spark, path, name) if fmt == "csv" else spark.read.format(fmt).load(path)
            df.schema  # resolves the path now: a missing mart raises here
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out[name] = df
    return out
