"""The build of the staged table: which lines it takes, what it moves, how it is written."""

from collections import Counter

from clickmart.operators.staging import staged_from_tables
from clickmart.plans import materialize, registry
from clickmart.sources.binding import bind_events, order_lines

EVENTS = "event_id long, user_id long, event_type string, value double, props string, ts timestamp_ntz"


def _tables(spark):
    """Repeated and null ids, an order without an event, a line without a part."""
    days = ["2024-01-01 10:00:00", "2024-01-02 11:00:00", "2024-01-03 12:00:00"]
    rows = [(i, 10 + i % 7, t, float(i), '{"k": %d}' % (i * 11 % 100), days[i % 3])
            for i, t in enumerate(["view", "click", "purchase", "error", "signup"] * 6)]
    rows += [rows[2], rows[6], (None, 11, "view", 1.0, '{"k": 1}', days[0])]
    events = spark.createDataFrame(rows, EVENTS.replace("timestamp_ntz", "string")).selectExpr("event_id", "user_id", "event_type", "value", "props", "cast(ts as timestamp_ntz) ts")
    lines = [(o, n, 100 + (o or 0) % 4, float(n)) for o in [*range(0, 40), None] for n in (1, 2, 3)] + [(2, 1, 102, 1.0), (3, 9, 999, 1.0)]
    lineitem = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double")
    part = spark.createDataFrame([(100 + i, f"part {i}", "B", t) for i, t in enumerate(["PROMO", "LARGE", "SMALL", "STANDARD"])],
                                 "p_partkey long, p_name string, p_brand string, p_type string")
    return events, lineitem, part


def test_lines_of_other_orders_go_before_the_parts(spark):
    _, lineitem, part = _tables(spark)
    asked = spark.createDataFrame([(2,), (2,), (77,), (None,)], "l_orderkey long")
    got = order_lines(lineitem, part, asked).collect()
    assert sorted((r["l_orderkey"], r["l_linenumber"]) for r in got) == [(2, 1), (2, 1), (2, 2), (2, 3)]


def test_arranged_events_are_the_same_rows(spark):
    tables = _tables(spark)
    plain, arranged = bind_events(*tables), bind_events(*tables, arrange=True)
    assert plain.schema == arranged.schema
    assert Counter(map(str, plain.collect())) == Counter(map(str, arranged.collect()))
    assert any(len(r["items"]) == 4 for r in plain.collect())  # order 2 has a line twice


def test_source_columns_are_moved_before_items_are_spread(spark):
    plan = staged_from_tables(spark, "/root/testdata/sf0.001", arrange=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RebalancePartitions")
    above = plan[:plan.index("RebalancePartitions")]
    assert above.count("Sort [event_date") == 1 and above.index("Generate explode") < above.index("Sort [event_date")


def test_staged_table_is_ordered_in_its_files(spark):
    sf = "/root/testdata/sf0.001"
    registry.stg(spark, sf)
    path = next(p for (_, name), (p, _) in materialize._TABLES.items() if name.startswith("stg_events:"))
    by_file = {}
    for r in spark.read.parquet(path).selectExpr("_metadata.file_path f", "_metadata.file_name", "event_name", "cast(event_date as string) d").collect():
        by_file.setdefault(r["f"], []).append((r["d"], r["event_name"]))
    assert all(rows == sorted(rows) and len({d for d, _ in rows}) == 1 for rows in by_file.values())
    assert sum(map(len, by_file.values())) == staged_from_tables(spark, sf).count()
    for key in materialize.ARRANGED_CONF:
        assert spark.conf.get(key) != materialize.ARRANGED_CONF[key]
