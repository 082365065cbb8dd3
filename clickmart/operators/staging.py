"""A01 stage_events: nested events -> one row per (event, item).

The grain is the one every downstream count uses: an event with n items gives
n rows, an event with no (or a NULL) item array keeps one row with NULL item
fields (``explode_outer``).  Parameters are looked up in the event's own
parameter array, so there is no join and no shuffle: the whole operator is one narrow, codegen'd projection on the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases

# Action types of the staging model, in rule order.
ACTION_TYPES = [
    ("view_item", "Product Detail"),
    ("add_to_cart", "Cart Action"),
    ("begin_checkout", "Checkout Start"),
    ("purchase", "Purchase"),
    ("view_promotion", "Promotion View"),
    ("select_promotion", "Promotion Click"),
]
DEFAULT_ACTION = "Browsing"
NOT_SET = "(not set)"


#: Staged column, parameter key and value slot of each parameter the staging model reads.
PARAMS = [
    ("session_source", "source", "string_value"),
    ("session_medium", "medium", "string_value"),
    ("session_campaign", "campaign", "string_value"),
    ("session_id", "ga_session_id", "int_value"),
    ("_engaged", "session_engaged", "int_value"),
    ("_engagement_ms", "engagement_time_msec", "int_value"),
    ("page_title", "page_title", "string_value"),
    ("page_url", "page_location", "string_value"),
]


def param_values(params=PARAMS, strict: bool = True) -> Column:
    """Struct of the values of ``params`` (column, key, slot) in ``event_params``.

    Absent key -> NULL.  A key present twice is an error, as a scalar subquery
    with two rows is; ``strict=False`` takes the first instead.  Keys are
    looked up by position; repeats are found in one pass over the keys.
    """
    keys, values = F.col("event_params.key"), F.col("event_params.value")
    found = F.struct(*[F.get(values, (F.array_position(keys, key) - 1).cast("int"))[slot].alias(column) for column, key, slot in params])
    if not strict:
        return found
    asked = F.filter(keys, lambda k: k.isin(*[key for _, key, _ in params]))
    repeated = F.size(F.array_distinct(asked)) < F.size(asked)
    return F.when(repeated, F.raise_error(F.concat(F.lit("an event parameter occurs more than once: "), F.array_join(asked, ", ")))).otherwise(found)


def stage_events(events: DataFrame, start_date: str | None = None, end_date: str | None = None,
                 strict_params: bool = True, has_event_id: bool = True) -> DataFrame:
    """Flatten nested events (``clickmart.schemas.NESTED_EVENT``) to staged rows.

    ``start_date``/``end_date`` (``YYYYMMDD``, inclusive) filter ``event_date``;
    on a dataset partitioned by ``event_date`` this is partition pruning.

    ``event_id`` breaks ties of the timestamp in ordered paths.  Where the
    export has none (no such column, or ``has_event_id=False``) missing ids
    are a hash of the event's content, which reads all its columns.
    """
    src = events
    if start_date is not None:
        src = src.filter(F.col("event_date") >= F.lit(start_date))
    if end_date is not None:
        src = src.filter(F.col("event_date") <= F.lit(end_date))
    if not has_event_id or "event_id" not in src.columns:
        content = F.xxhash64("event_timestamp", "event_name", "user_pseudo_id", "user_id", "event_params", "ecommerce", "items", "device", "geo")
        src = src.withColumn("event_id", F.coalesce("event_id", content) if "event_id" in src.columns else content)

    src = src.withColumn("_params", param_values(strict=strict_params))
    flat = src.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id", "event_id",
        *[F.col("_params")[column].alias(column) for column, _, _ in PARAMS],
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.explode_outer("items").alias("item"),
    )
    item = F.col("item")
    return flat.select(
        "event_date",
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        "user_pseudo_id",
        F.col("user_id").alias("member_id"),
        F.coalesce("user_id", "user_pseudo_id").alias("master_id"),
        F.when(F.col("user_id").isNotNull(), 1).otherwise(0).alias("is_member"),
        "session_source", "session_medium", "session_campaign",
        # concat is NULL when either part is NULL, like the reference's CONCAT.
        F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("session_id").cast("string")).alias("session_unique_id"),
        "session_id",
        F.coalesce("_engaged", F.lit(0).cast("bigint")).alias("is_engaged"),
        F.coalesce("_engagement_ms", F.lit(0).cast("bigint")).alias("engagement_time_msec"),
        "page_title", "page_url",
        F.coalesce(item["promotion_name"], F.lit(NOT_SET)).alias("promotion_name"),
        fold_cases([(F.col("event_name") == e, a) for e, a in ACTION_TYPES], DEFAULT_ACTION).alias("action_type"),
        "event_name", "transaction_id", "purchase_revenue",
        item["item_id"].alias("item_id"),
        item["item_name"].alias("item_name"),
        item["item_category"].alias("item_category"),
        item["price"].alias("item_price"),
        item["quantity"].alias("item_quantity"),
        (F.coalesce(item["price"], F.lit(0.0)) * F.coalesce(item["quantity"], F.lit(0))).alias("item_revenue_calc"),
        "device_category", "country", "event_id",
    )


def staged_from_tables(spark, sf_dir: str, arrange: bool = False, **kwargs) -> DataFrame:
    """Driver tables -> nested binding -> staged rows (what every query starts from)."""
    from clickmart.sources.binding import nested_events
    return stage_events(nested_events(spark, sf_dir, arrange), **kwargs)
