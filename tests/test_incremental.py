"""Daily states: session facts without a full refresh, sketches that merge, and the plans of the reworked marts."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from clickmart.operators import basket, scoring, sessions, sketches
from clickmart.operators.staging import stage_events
from clickmart.plans import registry
from clickmart.plans.incremental import SessionFacts
from clickmart.sources import io
from conftest import SF_MID, SF_SMALL
from fixtures import ev, frame, item
from tools.check_oracle import rows_of


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def facts_rows(df):
    df = df.withColumn("viewed_categories", F.concat_ws("|", F.array_sort("viewed_categories")))
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def events():
    shop = [item("Cap", "Home/Apparel/", 5.0, 2), item("Bag", "Home/Bags/", 30.0)]
    return [
        ev("2024-01-01 10:00:00", "session_start", "a", 1), ev("2024-01-01 10:01:00", "view_item", "a", 1, items=shop),
        ev("2024-01-01 23:58:00", "view_item", "b", 1, items=shop[:1]), ev("2024-01-02 00:01:00", "add_to_cart", "b", 1, items=shop[1:]),
        ev("2024-01-02 00:02:00", "purchase", "b", 1, items=shop, txn="T1", revenue=40.0), ev("2024-01-02 12:00:00", "page_view", "c", 1),
        ev("2024-01-03 23:00:00", "view_item", "c", 2, items=shop), ev("2024-01-04 01:00:00", "view_item", "c", 2, items=[item("Mug", None, 7.0)]),
        ev("2024-01-04 09:00:00", "page_view", "d", None), ev("2024-01-01 09:00:00", "page_view", "d", None), ev("2024-01-06 09:00:00", "view_item", "e", 5, items=shop)]


def test_updates_equal_one_pass(spark, tmp_path):
    staged = stage_events(frame(spark, events())).cache()
    want = facts_rows(sessions.session_features(staged))
    days = ["20240101", "20240102", "20240103", "20240104", "20240106"]
    for orders in ([days], [days[:2], days[2:]], [[d] for d in days], [[d] for d in reversed(days)], [days[2:], days[:2], days[1:2]]):
        facts = SessionFacts(spark, str(tmp_path / f"facts-{time.time_ns()}"))
        for brought in orders:
            assert facts.update(staged.where(F.col("event_date").isin(brought)))["brought"] == set(brought)
        assert facts_rows(facts.read()) == want
        # b's and c's rows lie with their last day only.
        assert facts.days("facts") == set(days) - {"20240103"}
    assert facts.update(staged.where("event_date = '19990101'")) == {"brought": set(), "written": set()}


def test_a_day_brought_again_replaces_its_state(spark, tmp_path):
    facts = SessionFacts(spark, str(tmp_path / "facts"))
    first = stage_events(frame(spark, events()))
    facts.update(first)
    # Of b's second day nothing is left, and a late event of a comes in.
    later = [e for e in events() if not (e[0] == "20240102" and e[3] == "b")] + [ev("2024-01-02 00:05:00", "purchase", "a", 1, items=[item("Pen", "Home/Office/", 1.0)], revenue=1.0)]
    second = stage_events(frame(spark, later))
    result = facts.update(second.where("event_date = '20240102'"))
    assert result["written"] == {"20240101", "20240102"}
    assert facts_rows(facts.read()) == facts_rows(sessions.session_features(second))


def test_other_days_are_not_read(spark, tmp_path):
    """The files of days beyond the span are made unreadable: an update neither reads nor writes them."""
    staged = stage_events(frame(spark, events())).cache()
    facts = SessionFacts(spark, str(tmp_path / "facts"))
    facts.update(staged.where("event_date < '20240105'"))
    spoiled = [f for d in ("20240101", "20240102") for t in ("partials", "facts") for f in glob.glob(f"{tmp_path}/facts/{t}/*={d}/*.parquet")]
    assert len(spoiled) >= 4
    for f in spoiled:
        for path in (f, os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")):
            if os.path.exists(path):
                os.remove(path)
        with open(f, "wb") as out:
            out.write(b"not a parquet file")
    assert facts.update(staged.where("event_date in ('20240104', '20240106')"))["written"] == {"20240104", "20240106"}
    assert all(os.path.getsize(f) == len(b"not a parquet file") for f in spoiled)
    with pytest.raises(Exception):
        facts.read().collect()


def test_a_session_over_too_many_days_is_an_error(spark, tmp_path):
    rows = [ev("2024-01-01 10:00:00", "page_view", "a", 1), ev("2024-01-03 10:00:00", "page_view", "a", 1)]
    staged = stage_events(frame(spark, rows))
    with pytest.raises(ValueError, match="max_span_days"):
        SessionFacts(spark, str(tmp_path / "one")).update(staged)
    facts = SessionFacts(spark, str(tmp_path / "two"), max_span_days=2)
    for day in ("20240103", "20240101"):
        facts.update(staged.where(F.col("event_date") == day))
    assert [r["path_length"] for r in facts.read().collect()] == [2]


# ------------------------------------------------------------------ sketches
def test_sketch_states_of_days_merge(spark, tmp_path):
    """States written day by day give the same figures as one pass, within the sketches' bounds."""
    staged = registry.stg(spark, SF_MID)
    days = sorted(r[0] for r in staged.select("event_date").distinct().collect())
    path = str(tmp_path / "prices")
    for part in (days[:9], days[9:20], days[20:]):
        made = sketches.daily_price_sketches(staged.where(F.col("event_date").isin(part)), 200)
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    kept = spark.read.schema("views long, prices binary, event_date string").parquet(path)
    errors = sketches.price_cutoff_errors(staged, kept, k=200).collect()
    views = staged.where("event_name = 'view_item' and item_price > 0").count()
    assert [r["quantile"] for r in errors] == [0.33, 0.66] and all(r["n_views"] == views for r in errors)
    assert all(r["rank_error"] <= r["rank_bound"] for r in errors)
    # A state of the wrong days is found out by the same measure.
    low = sketches.daily_price_sketches(staged.where("item_price < 20"))
    assert max(r["rank_error"] for r in sketches.price_cutoff_errors(staged, low).collect()) > 0.1


def test_style_summary_from_sketches_has_exact_counts(spark):
    styles = registry.styles(spark, SF_MID)
    made = sketches.style_summary_from_sketches(sketches.daily_style_sketches(styles, registry.sess(spark, SF_MID)))
    exact = registry.QUERIES["browsing_style_summary"](spark, SF_MID)
    assert sorted(made.columns) == sorted(exact.columns)
    shown = [c for c in exact.columns if not c.startswith("item_viewed")] + ["item_viewed_p100"]
    assert rows_of(shown, [tuple(r) for r in made.select(*shown).collect()]) == rows_of(shown, [tuple(r) for r in exact.select(*shown).collect()])


def test_distinct_sessions_over_days(spark):
    """40,000 sessions, each on two days: the merged sketch counts each once, within its bound."""
    rows = spark.range(80_000).select(
        F.concat(F.lit("2024010"), (F.col("id") % 2 + 1).cast("string")).alias("event_date"),
        F.when(F.col("id") % 8 < 2, "purchase").otherwise("view_item").alias("event_name"),
        F.concat(F.lit("s-"), (F.col("id") / 2).cast("long").cast("string")).alias("session_unique_id"))
    got = {r["step_order"]: r for r in sketches.open_funnel_from_sketches(sketches.daily_session_sketches(rows)).collect()}
    for order, exact in ((1, 40_000), (2, 30_000), (3, 0), (4, 10_000)):
        assert abs(got[order]["user_count"] - exact) <= sketches.distinct_bound() * exact
        assert got[order]["n_days"] == 2
    assert got[4]["conversion_rate"] is None and got[1]["conversion_rate"] == 1.0


def test_sketches_of_nothing(spark):
    staged = stage_events(frame(spark, [ev("2024-01-01 10:00:00", "page_view", "a", 1)]))
    days = sketches.daily_price_sketches(staged)
    assert sketches.price_cutoff_errors(staged, days).collect() == []
    assert sketches.price_cutoffs_from_sketches(days).collect()[0]["cutoffs"] is None
    assert sketches.price_tier_from_state(sketches.daily_item_prices(staged), days).collect() == []
    assert [r["user_count"] for r in sketches.open_funnel_from_sketches(sketches.daily_session_sketches(staged)).collect()] == [1, 0, 0, 0]


# ------------------------------------------------------------------ plans
def test_narrow_read_of_staged_rows_prunes(spark, tmp_path):
    from clickmart.sources.binding import nested_events
    nested_events(spark, SF_SMALL).write.parquet(str(tmp_path / "nested"))
    source = spark.read.parquet(str(tmp_path / "nested"))
    narrow = stage_events(source).select("event_id", "event_name", "event_timestamp")
    read = [line for line in plan(narrow).splitlines() if "ReadSchema" in line]
    assert read and all("event_params" not in line and "ecommerce" not in line and "device" not in line for line in read)
    hashed = stage_events(source.drop("event_id")).select("event_id").distinct().count()
    assert hashed == stage_events(source.withColumn("event_id", F.lit(None).cast("long")), has_event_id=False).select("event_id").distinct().count() > 100


def test_pairs_of_ordinary_baskets_take_two_exchanges(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.createDataFrame([("t1", "s1", "a"), ("t1", "s1", "b"), ("t1", "s1", "b"), ("t1", "s2", "c"), ("t2", "s1", "b"), (None, "s1", "a"), ("t1", None, "c")],
                                      "transaction_id string, session_unique_id string, item_name string")
        base = lines.groupBy("transaction_id", "session_unique_id", "item_name").count().withColumnRenamed("count", "n")
        large = base.groupBy("transaction_id").count().where("count > 500").select("transaction_id")
        s = plan(basket._basket_pairs(base.join(large, "transaction_id", "left_anti"), "transaction_id", ["session_unique_id"], "item_name"))
        # The lines are reduced by one exchange and come together by another; gathering and pairing add none.
        assert "Exchange" not in s[:s.index("SortMergeJoin")]
        left = s[s.index("SortMergeJoin"):].split("Exchange hashpartitioning(transaction_id")
        assert len(left) >= 3
        got = sorted((tuple(r) for r in basket.weighted_pairs(lines).collect()), key=str)
        assert got == sorted((tuple(r) for r in basket.weighted_pairs(lines, block_items=1).collect()), key=str)
        assert got == sorted([("t1", "s1", "a", "b", 2), ("t1", "s1", "a", "c", 2), ("t1", "s1", "b", "c", 4)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bundle_facts_join_lines_not_pairs(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = plan(registry.QUERIES["bundle_strategy"](spark, SF_SMALL))
        by_session = [line for line in s.splitlines() if "Exchange hashpartitioning(session_unique_id" in line]
        assert by_session
        # Above the point where pairs exist nothing is dealt by session.
        top = s[:s.index("Union")] if "Union" in s else s
        assert "Exchange hashpartitioning(session_unique_id" not in top
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_core_sessions_read_the_path_table(spark):
    s = plan(registry.QUERIES["core_sessions"](spark, SF_SMALL))
    assert "event_name" not in s and "Window" not in s and "session_paths" in s
    direct = scoring.core_sessions(registry.feats(spark, SF_SMALL), stg=registry.stg(spark, SF_SMALL))
    got = registry.QUERIES["core_sessions"](spark, SF_SMALL)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(direct.columns, [tuple(r) for r in direct.collect()])


def test_export_shards_and_range(spark, tmp_path):
    rows = frame(spark, events())
    path = str(tmp_path / "export")
    io.write_events(rows, path)
    dates = io.shard_dates(spark, path)
    assert dates == ["20240101", "20240102", "20240103", "20240104", "20240106"]
    assert io.read_events(spark, path, dates[0], dates[-1]).count() == rows.count()
    part = io.read_events(spark, path, dates[1], dates[2])
    assert {r[0] for r in part.select("event_date").distinct().collect()} == set(dates[1:3])
    assert "PartitionFilters: [isnotnull(event_date" in plan(part)
