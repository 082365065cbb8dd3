import pytest
from pyspark.sql import functions as F

from clickmart.operators.staging import stage_events
from clickmart.schemas import STAGED_COLUMNS
from fixtures import ev, frame, item


def test_grain_one_row_per_item_and_outer(spark):
    rows = [
        ev("2024-01-05 10:00:00", "view_item", items=[item("A"), item("B"), item("C")]),
        ev("2024-01-05 10:01:00", "view_item", items=[]),
        ev("2024-01-05 10:02:00", "page_view", items=None),
        ev("2024-01-05 10:03:00", "add_to_cart", items=[item("A", price=None, quantity=3)]),
        ev("2024-01-05 10:04:00", "add_to_cart", items=[item("B", price=4.0, quantity=None)]),
    ]
    stg = stage_events(frame(spark, rows))
    assert stg.columns == STAGED_COLUMNS
    got = stg.orderBy("event_id", "item_name").collect()
    assert len(got) == 3 + 1 + 1 + 1 + 1
    empty = [r for r in got if r.event_name == "page_view"][0]
    assert empty.item_name is None and empty.item_revenue_calc == 0.0
    assert empty.promotion_name == "(not set)"
    assert [r.item_revenue_calc for r in got if r.event_name == "add_to_cart"] == [0.0, 0.0]
    assert [r.action_type for r in got][:1] == ["Product Detail"]


def test_params_session_and_member(spark):
    rows = [
        ev("2024-01-05 10:00:00", "session_start", user="u1", gsid=7, user_id="M1",
           params={"source": "google", "medium": "cpc", "page_title": "Home", "session_engaged": 1}),
        ev("2024-01-05 10:00:00", "page_view", user="u2", gsid=None),
        # value in the other typed slot reads NULL
        ev("2024-01-05 10:00:00", "page_view", user="u3", gsid=3, extra_params=[("source", (None, 5))]),
    ]
    got = {r.user_pseudo_id: r for r in stage_events(frame(spark, rows)).collect()}
    r1 = got["u1"]
    assert (r1.session_unique_id, r1.session_id, r1.member_id, r1.master_id, r1.is_member) == ("u1-7", 7, "M1", "M1", 1)
    assert (r1.session_source, r1.session_medium, r1.page_title, r1.is_engaged) == ("google", "cpc", "Home", 1)
    assert r1.engagement_time_msec == 0
    r2 = got["u2"]
    assert r2.session_unique_id is None and r2.master_id == "u2" and r2.is_member == 0
    assert got["u3"].session_source is None


def test_duplicate_param_is_an_error(spark):
    rows = [ev("2024-01-05 10:00:00", "page_view", params={"source": "a"}, extra_params=[("source", ("b", None))])]
    df = frame(spark, rows)
    with pytest.raises(Exception, match="occurs more than once"):
        stage_events(df).collect()
    assert stage_events(df, strict_params=False).collect()[0].session_source == "a"


def test_export_without_ids_has_a_tie_break(spark):
    rows = [ev("2024-01-05 10:00:00", "view_item", items=[item("A")]), ev("2024-01-05 10:00:00", "view_item", items=[item("B")]),
            ev("2024-01-05 10:00:00", "page_view", event_id=77)]
    named = frame(spark, rows)
    for df in (named.withColumn("event_id", F.when(F.col("event_id") == 77, F.col("event_id"))), named.drop("event_id")):
        got = stage_events(df, has_event_id=False).collect()
        ids = {(r.event_name, r.item_name): r.event_id for r in got}
        assert len(set(ids.values())) == 3 and None not in ids.values()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, stage_events(df.repartition(3), has_event_id=False).collect()), key=str)
    assert {r.event_id for r in stage_events(named).collect()} >= {77}


def test_binding_keeps_repeated_events(spark):
    from clickmart.sources.binding import bind_events, read_tables
    from conftest import SF_SMALL
    t = read_tables(spark, SF_SMALL)
    twice = t["events"].unionByName(t["events"].limit(50))
    assert bind_events(twice, t["lineitem"], t["part"]).count() == t["events"].count() + 50


def test_action_types(spark):
    names = ["view_item", "add_to_cart", "begin_checkout", "purchase", "view_promotion", "select_promotion", "scroll"]
    rows = [ev("2024-01-05 10:00:00", n) for n in names]
    got = {r.event_name: r.action_type for r in stage_events(frame(spark, rows)).collect()}
    assert got == {"view_item": "Product Detail", "add_to_cart": "Cart Action", "begin_checkout": "Checkout Start",
                   "purchase": "Purchase", "view_promotion": "Promotion View",
                   "select_promotion": "Promotion Click", "scroll": "Browsing"}


def test_date_range_and_partition_pruning(spark, tmp_path):
    rows = [ev("2024-01-04 23:00:00", "page_view"), ev("2024-01-05 10:00:00", "page_view"),
            ev("2024-01-06 10:00:00", "page_view")]
    path = str(tmp_path / "events")
    frame(spark, rows).write.partitionBy("event_date").parquet(path)
    src = spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("string"))
    stg = stage_events(src, "20240105", "20240106")
    assert sorted(r.event_date for r in stg.collect()) == ["20240105", "20240106"]
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
