"""Binding of the driver tables (events, lineitem, part) to the nested
web-analytics event schema the staging model reads.

The derivation uses integer arithmetic only, so Spark and the DuckDB oracle
produce identical rows.  Order lines are folded into one bounded item array
per order; the events, untouched and one row each even where an id repeats,
are then joined to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding (they define the test data, see FIXTURES.md §2.2).
TEN_DAYS_US = 864_000_000_000
TWO_DAYS_US = 172_800_000_000
HUNDRED_DAYS_US = 8_640_000_000_000
HOUR_US = 3_600_000_000
VISIT_US = 5_400_000_000  # no session is longer than 90 minutes
HEAVY_USER = 4  # last digit of the users whose events are one session, errors counting as views
NO_SESSION_EVERY, NO_SESSION_REST = 97, 50  # events without a session id
RARE_CLICK = 40  # one in so many clicks on the last promotion is kept
ITEM_EVENTS = ["view_item", "add_to_cart", "begin_checkout", "purchase"]
PROMO_EVENTS = ["view_promotion", "select_promotion"]
PAGE_URL_PREFIX = "https://shop.example/p/"


def read_tables(spark: SparkSession, sf_dir: str, names=("events", "lineitem", "part")):
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _param(key: str, *, string_value: Column | None = None, int_value: Column | None = None,
           present: Column | None = None) -> Column:
    value = F.struct(
        (string_value if string_value is not None else F.lit(None).cast("string")).alias("string_value"),
        (int_value if int_value is not None else F.lit(None).cast("bigint")).alias("int_value"),
    )
    p = F.struct(F.lit(key).alias("key"), value.alias("value"))
    return p if present is None else F.when(present, p)


def _event_name(event_type: Column, k: Column, heavy: Column) -> Column:
    clicked = (k < 75) | (F.col("event_id") % RARE_CLICK == 0)
    return (
        F.when(event_type == "view", F.when(k % 5 == 0, "view_promotion").otherwise("view_item"))
        .when(event_type == "click", F.when(k % 5 != 0, "add_to_cart").when(clicked, "select_promotion").otherwise("page_view"))
        .when(event_type == "signup", F.when(k < 50, "session_start").otherwise("view_search_results"))
        .when(event_type == "purchase",
              F.when(k < 12, "purchase").when(k < 60, "begin_checkout").otherwise("add_payment_info"))
        .when(event_type == "error", F.when(heavy, "view_item").otherwise("page_view"))
    )


def order_lines(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of ``orders`` (l_orderkey) with the part attributes the items need.

    Lines of other orders go before the parts' names come to them."""
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(orders, "l_orderkey", "left_semi")
    parts = part.select("p_partkey", "p_name", "p_brand", "p_type")
    return lines.join(parts, lines.l_partkey == parts.p_partkey, "inner").drop("l_partkey")


def bind_events(events: DataFrame, lineitem: DataFrame, part: DataFrame, arrange: bool = False) -> DataFrame:
    """Driver tables -> nested events (schema ``clickmart.schemas.NESTED_EVENT``).

    ``arrange`` brings the rows of a date together, ordered by event name in
    it, before the nested columns are made: it moves the few source columns,
    not the many that follow from them."""
    uid = F.col("uid")
    heavy = uid % 10 == HEAVY_USER
    ev = events.select(
        "event_id", F.col("user_id").alias("uid"), "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    ).withColumn("blen", F.when(heavy, F.lit(HUNDRED_DAYS_US)).when(uid % 2 == 0, F.lit(TEN_DAYS_US)).otherwise(F.lit(TWO_DAYS_US)))
    ev = ev.withColumn("ga_session_id", F.expr("us div blen")).withColumn(
        "ts_us", F.expr(f"(us div blen) * blen + (uid % 24) * {HOUR_US}L + (us % blen) div (blen div {VISIT_US}L)"),
    ).withColumn("event_name", _event_name(F.col("event_type"), F.col("k"), heavy))

    # An order has a bounded number of lines, so the array is small.
    line = F.struct("l_linenumber", "p_partkey", "p_name", "p_brand", "p_type", "l_quantity")
    bought = ev.filter(F.col("event_name").isin(*ITEM_EVENTS)).select(F.col("event_id").alias("l_orderkey"))
    orders = order_lines(lineitem, part, bought).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    ev = ev.join(orders, (ev.event_id == orders.l_orderkey) & ev.event_name.isin(*ITEM_EVENTS), "left").drop("l_orderkey")
    ev = ev.withColumn("event_date", F.date_format(F.timestamp_micros("ts_us"), "yyyyMMdd"))
    if arrange:
        ev = ev.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event_name")

    k = F.col("k")
    mod4 = uid % 4
    source = F.when(mod4 == 1, "google").when(mod4 == 2, "partner").when(mod4 == 3, "google")
    medium = F.when(mod4 == 1, "organic").when(mod4 == 2, "referral").when(mod4 == 3, "cpc")
    params = F.filter(F.array(
        _param("source", string_value=source, present=mod4 != 0),
        _param("medium", string_value=medium, present=mod4 != 0),
        _param("campaign", string_value=F.concat(F.lit("c"), F.expr("k div 10").cast("string")),
               present=mod4 == 3),
        _param("page_title", string_value=F.concat(F.lit("Page "), (k % 10).cast("string"))),
        _param("page_location", string_value=F.concat(F.lit(PAGE_URL_PREFIX), k.cast("string"))),
        _param("ga_session_id", int_value=F.col("ga_session_id"), present=F.col("event_id") % NO_SESSION_EVERY != NO_SESSION_REST),
        _param("session_engaged", int_value=(k % 2).cast("bigint"), present=F.col("event_id") % 3 != 0),
        _param("engagement_time_msec", int_value=(k * 100).cast("bigint"), present=k >= 10),
    ), lambda p: p.isNotNull())

    user_mod3 = uid % 3

    def line_to_item(line: Column) -> Column:
        name = line["p_name"]
        category = (
            F.when(user_mod3 == 0, F.lit("Home/Apparel/"))
            .when(line["p_type"] == "PROMO", F.lit(None).cast("string"))
            .when(line["p_type"] == "LARGE", F.lit("Home/Bags/"))
            .when(line["p_type"] == "SMALL", F.concat(F.lit("Home/Shop by Brand/"), line["p_brand"], F.lit("/")))
            .otherwise(F.lit("Home/Apparel/"))
        )
        price = (F.lit(3) + (F.ascii(name) * 7 + F.length(name) * 13) % 97).cast("double")
        return F.struct(
            line["p_partkey"].cast("string").alias("item_id"),
            name.alias("item_name"),
            category.alias("item_category"),
            price.alias("price"),
            line["l_quantity"].cast("bigint").alias("quantity"),
            F.lit(None).cast("string").alias("promotion_name"),
        )

    promo_item = F.struct(
        *[F.lit(None).cast(t).alias(n) for n, t in
          [("item_id", "string"), ("item_name", "string"), ("item_category", "string"),
           ("price", "double"), ("quantity", "bigint")]],
        F.concat(F.lit("Promo "), F.expr("chr(65 + k div 25)")).alias("promotion_name"),
    )
    empty_items = F.array().cast("array<struct<item_id:string,item_name:string,item_category:string,"
                                 "price:double,quantity:bigint,promotion_name:string>>")
    items = (
        F.when(F.col("event_name").isin(*ITEM_EVENTS),
               F.coalesce(F.transform(F.col("lines"), line_to_item), empty_items))
        .when(F.col("event_name").isin(*PROMO_EVENTS), F.array(promo_item))
        .otherwise(empty_items)
    )
    is_purchase = F.col("event_name") == "purchase"
    return ev.select(
        "event_date",
        F.col("ts_us").alias("event_timestamp"),
        F.col("event_name"),
        uid.cast("string").alias("user_pseudo_id"),
        F.when(uid % 5 == 0, F.concat(F.lit("M"), uid.cast("string"))).alias("user_id"),
        params.alias("event_params"),
        F.when(is_purchase, F.struct(
            F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("transaction_id"),
            F.floor("value").cast("double").alias("purchase_revenue"),
        )).alias("ecommerce"),
        items.alias("items"),
        F.struct(F.when(user_mod3 == 0, "desktop").when(user_mod3 == 1, "mobile")
                 .otherwise("tablet").alias("category")).alias("device"),
        F.struct(F.concat(F.lit("C"), (uid % 25).cast("string")).alias("country")).alias("geo"),
        F.col("event_id"),
    )


def nested_events(spark: SparkSession, sf_dir: str, arrange: bool = False) -> DataFrame:
    t = read_tables(spark, sf_dir)
    return bind_events(t["events"], t["lineitem"], t["part"], arrange)
