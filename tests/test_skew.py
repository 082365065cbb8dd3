"""Hot keys: one session, transaction, item and promotion hold a third or
more of the rows.  With AQE forced to treat them as skewed (tiny thresholds,
no broadcast), results still equal the SQL definition and the hot join
partitions are split."""

import duckdb

from clickmart.operators import scoring
from clickmart.operators import sessions as S
from clickmart.operators.staging import stage_events
from clickmart.plans import materialize
from clickmart.plans import oracle as O
from clickmart.plans import registry
from fixtures import ev, frame, item
from test_differential import make_events
from tools.check_oracle import rows_of

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
QUERIES = ["session_funnel", "session_paths", "engage_lift_score", "core_sessions", "cart_abandon", "promo_quality",
           "device_friction", "bundle_strategy", "product_association", "time_to_conversion", "funnel_overall"]


def hot_events():
    rows = make_events(5, n=300)
    n = len(rows) + 1000
    # one session with ~1/3 of all rows: views, carts of one hot item, promo clicks, one big transaction
    for i in range(700):
        name = ["view_item", "add_to_cart", "select_promotion", "page_view"][i % 4]
        items = ([item("Google Bag", "Home/Bags/", 30.0, 1 + i % 3)] if name in ("view_item", "add_to_cart")
                 else [item(None, None, None, None, promo="P-big")] if name == "select_promotion" else ())
        rows.append(ev(f"2024-01-03 {10 + i // 120:02d}:{(i // 2) % 60:02d}:00", name, "hot", 1, items=items,
                       event_id=n + i))
    rows.append(ev("2024-01-03 18:00:00", "purchase", "hot", 1, txn="T-hot", revenue=99.0, event_id=n + 800,
                   items=[item(nm) for nm in ["Tee", "Cap", "Mug", "Pen", "Sock"] * 20]))
    return rows


def test_hot_keys_match_sql_with_skew_splitting(spark, monkeypatch):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        staged = stage_events(frame(spark, hot_events())).repartition(8).cache()
        monkeypatch.setattr(registry, "stg", lambda spark_, sf: staged)
        monkeypatch.setattr(registry, "feats", lambda spark_, sf: S.session_features(staged))
        # fixture models are built in place, not cached as tables under a source signature
        monkeypatch.setattr(materialize, "table", lambda spark_, name, sig, build, **layout: build())
        pdf = staged.toPandas()
        hot_share = (pdf["session_unique_id"] == "hot-1").mean()
        assert hot_share > 0.3
        con = duckdb.connect()
        con.sql("SET TimeZone='UTC'")
        con.register("stg_fixture", pdf)
        skew_split = False
        for name in QUERIES:
            q = registry.ORACLE[name].replace(O.STG_CTE.strip(), "stg AS (SELECT * FROM stg_fixture)")
            res = con.sql(q)
            df = registry.QUERIES[name](spark, "<fixture>")
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            assert got == rows_of(res.columns, res.fetchall()), name
            final = df._jdf.queryExecution().executedPlan().toString()
            skew_split = skew_split or "skew=true" in final
        # Core sessions straight from the staged rows join all rows of the hot session.
        direct = scoring.core_sessions(registry.feats(spark, ""), scores=registry.graded(spark, ""), stg=staged)
        res = con.sql(registry.ORACLE["core_sessions"].replace(O.STG_CTE.strip(), "stg AS (SELECT * FROM stg_fixture)"))
        assert rows_of(direct.columns, [tuple(r) for r in direct.collect()]) == rows_of(res.columns, res.fetchall())
        assert skew_split or "skew=true" in direct._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_huge_basket_is_spread_over_tasks(spark):
    """Default skew thresholds, no broadcast: one basket of 3,000 items and many small ones."""
    from pyspark.sql import functions as F

    from clickmart.operators.basket import weighted_pairs
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(3000).select(F.lit("big").alias("t"), F.format_string("i%05d", "id").alias("i"))
        small = spark.range(4000).select(F.format_string("s%d", F.expr("id div 2")).alias("t"), F.format_string("i%05d", F.expr("id % 50")).alias("i"))
        pairs = weighted_pairs(big.union(small).repartition(8), "t", None, "i")
        by_task = {r["p"]: r["n"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(by_task.values()) == 3000 * 2999 // 2 + 2000
        assert len(by_task) >= 4 and max(by_task.values()) < 0.5 * sum(by_task.values())
        small_blocks = weighted_pairs(small, "t", None, "i", block_items=1)
        assert sorted(map(tuple, small_blocks.collect())) == sorted(map(tuple, weighted_pairs(small, "t", None, "i").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_path_pieces_of_a_busy_hour(spark):
    staged = stage_events(frame(spark, hot_events()))
    whole = S.session_paths(staged)
    assert sorted(map(str, whole.collect())) == sorted(map(str, S.session_paths(staged, max_rows=7).collect()))
    pieces = S.session_path_pieces(staged, max_rows=7).where("session_unique_id = 'hot-1'").collect()
    assert len(pieces) > 40 and max(r.path_length for r in pieces) < 110
