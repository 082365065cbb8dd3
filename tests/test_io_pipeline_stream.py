import pytest
from pyspark.sql import functions as F

from clickmart.conf import ensure_checkpoint_dir
from clickmart.operators.staging import stage_events
from clickmart.plans import materialize, pipeline
from clickmart.plans.materialize import source_signature
from clickmart.sources import io
from clickmart.sources.binding import nested_events
from clickmart.streaming.staging import stage_events_stream
from conftest import SF_SMALL
from tools.check_oracle import rows_of


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_partitioned_export_roundtrip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "export")
    nested = nested_events(spark, SF_SMALL)
    io.write_events(nested, path)
    back = io.read_events(spark, path)
    assert back.count() == nested.count()
    dates = sorted(r[0] for r in back.select("event_date").distinct().collect())
    one = io.read_events(spark, path, dates[1], dates[1])
    assert one.select("event_date").distinct().count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan


def test_mart_csv_roundtrip_and_missing_skipped(spark, tmp_path):
    df = spark.createDataFrame([("Light Browser", 532, 2.4, 1.6, 1.0, 2.0, 2.0, 2.0, 2.0, 5.451)],
                               io.MART_SCHEMAS["browsing_style"])
    io.write_mart(df, str(tmp_path / "browsing_style"), fmt="csv", single_file=True)
    got = io.load_marts(spark, {"browsing_style": str(tmp_path / "browsing_style"),
                                "cart_abandon": str(tmp_path / "missing")},
                        fmt="csv")
    assert set(got) == {"browsing_style"}
    r = got["browsing_style"].select("browsing_style", "session_count", "conversion_rate").collect()[0]
    assert tuple(r) == ("Light Browser", 532, 5.451)


def test_corrupt_mart_is_an_error(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not a parquet file")
    assert io.load_marts(spark, {"x": str(tmp_path / "none")}, fmt="parquet") == {}
    with pytest.raises(Exception):
        io.load_marts(spark, {"x": str(tmp_path / "bad")}, fmt="parquet")


def test_changed_snapshot_has_another_signature(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    first = source_signature(spark, [path])
    assert first == source_signature(spark, [path])
    spark.range(6).write.mode("append").parquet(path)
    assert source_signature(spark, [path]) != first


def test_written_tables_can_be_dropped(spark, tmp_path):
    import os
    materialize.table(spark, "probe", "s", lambda: spark.range(3).toDF("x"))
    key = (spark.sparkContext.applicationId, "probe:s")
    path = materialize._TABLES[key][0].removeprefix("file:")
    assert os.path.isdir(path)
    kept = {k: v for k, v in materialize._TABLES.items() if k != key}
    materialize._TABLES.clear()
    materialize._TABLES[key] = (path, None)
    materialize.drop_tables(spark)
    materialize._TABLES.update(kept)
    assert not os.path.exists(path) and key not in materialize._TABLES


def test_session_without_a_shared_folder_is_told(monkeypatch):
    class Bare:
        class sparkContext:
            master = "spark://cluster"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Bare)
    named = []
    Bare.sparkContext.getCheckpointDir = staticmethod(lambda: "/shared/x")
    Bare.sparkContext.setCheckpointDir = staticmethod(named.append)
    assert ensure_checkpoint_dir(Bare) == "/shared/x" and named == []


def test_staged_full_refresh_and_daily_overwrite(spark, tmp_path):
    path = str(tmp_path / "stg")
    stg = stage_events(nested_events(spark, SF_SMALL))
    dates = sorted(r[0] for r in stg.select("event_date").distinct().collect())[:2]
    both, one = stg.filter(F.col("event_date").isin(dates)), stg.filter(F.col("event_date") == dates[0])
    io.write_staged(both, path)
    io.write_staged(one, path, daily=True)
    assert spark.read.parquet(path).select("event_date").distinct().count() == 2
    io.write_staged(one, path)
    assert spark.read.parquet(path).select("event_date").distinct().count() == 1


def test_build_all_matches_registered_queries(spark, tmp_path):
    from clickmart.plans.registry import QUERIES
    models = pipeline.build_all(nested_events(spark, SF_SMALL), materialize="table")
    elsewhere = {"market_basket_orders", "chi_square_pvalues", "chi_square_2x2", "segment_ci_from_mart", "segment_compare_from_mart",
                 "mart_csv_roundtrip", "events_export_roundtrip"}
    assert set(QUERIES) - set(models) == elsewhere
    for name, df in models.items():
        got, want = df, QUERIES[name](spark, SF_SMALL)
        if "p_value" in got.columns:
            got = got.withColumn("p_value", F.round("p_value", 12))
        assert _rows(got) == _rows(want), name
    paths = pipeline.write_all({k: models[k] for k in ["stage_events", "funnel_overall"]}, str(tmp_path / "out"))
    assert spark.read.parquet(paths["funnel_overall"]).count() == 1


def test_streaming_staging_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    io.write_events(nested_events(spark, SF_SMALL), src)
    sink = str(tmp_path / "sink")
    with pytest.raises(TypeError):
        stage_events_stream(spark, src, sink)
    q = stage_events_stream(spark, src, sink, checkpoint_path=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(sink).withColumn("event_date", F.col("event_date").cast("string"))
    batch = stage_events(io.read_events(spark, src))
    cols = sorted(batch.columns)
    assert _rows(streamed.select(*cols)) == _rows(batch.select(*cols))


def test_build_all_modes_agree(spark):
    nested = nested_events(spark, SF_SMALL)
    names = ["funnel_overall", "cart_abandon", "device_friction", "segment_ci_table", "core_sessions"]
    results = {}
    for mode in ["persist", "checkpoint", "none"]:
        models = pipeline.build_all(nested, materialize=mode)
        results[mode] = {n: _rows(models[n]) for n in names}
    assert results["persist"] == results["checkpoint"] == results["none"]
