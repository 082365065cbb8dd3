"""Nested source schema (the web-analytics export the staging model reads)
and the flat staged schema."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

ITEM = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("item_category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("promotion_name", T.StringType()),
])

NESTED_EVENT = T.StructType([
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("ecommerce", T.StructType([
        T.StructField("transaction_id", T.StringType()),
        T.StructField("purchase_revenue", T.DoubleType()),
    ])),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
    T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("event_id", T.LongType()),
])

STAGED_COLUMNS = [
    "event_date", "event_timestamp", "user_pseudo_id", "member_id", "master_id", "is_member",
    "session_source", "session_medium", "session_campaign", "session_unique_id", "session_id",
    "is_engaged", "engagement_time_msec", "page_title", "page_url", "promotion_name",
    "action_type", "event_name", "transaction_id", "purchase_revenue", "item_id", "item_name",
    "item_category", "item_price", "item_quantity", "item_revenue_calc", "device_category",
    "country", "event_id",
]
