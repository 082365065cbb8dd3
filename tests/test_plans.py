"""Plan assertions: the physical shape the scale design relies on."""

from clickmart.operators import cart, scoring, sessions
from clickmart.operators.staging import stage_events
from clickmart.plans import registry
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_is_narrow(spark, tmp_path):
    from clickmart.sources.binding import nested_events
    p = str(tmp_path / "nested")
    nested_events(spark, SF_SMALL).write.parquet(p)
    s = plan(stage_events(spark.read.parquet(p)))
    assert "Exchange" not in s and "Generate" in s


def test_session_features_one_shuffle(spark):
    stg = registry.stg(spark, SF_SMALL)
    s = plan(sessions.session_features(stg))
    assert s.count("Exchange hashpartitioning") == 1


def test_score_grades_without_a_session_join(spark):
    df = scoring.engage_lift_score(registry.feats(spark, SF_SMALL))
    s = plan(df)
    assert "Join" not in s
    # the unpartitioned window reads the score histogram, never the sessions
    window = s[s.index("Window "):]
    assert "HashAggregate" in window and window.index("SinglePartition") < window.index("HashAggregate")


def test_histogram_is_bounded_by_the_scores(spark):
    feats = registry.feats(spark, SF_SMALL)
    rows = scoring.rank_histogram(feats, "engagement_score").count()
    total = feats.agg({"engagement_score": "sum"}).first()[0]
    assert rows <= (2 * total) ** 0.5 + 1


def test_cart_exchanges(spark):
    """Cart rows to sessions, item totals to items; the abandoned sessions are the semi-join's other side."""
    s = plan(cart.cart_abandon(registry.stg(spark, SF_SMALL), registry.graded(spark, SF_SMALL).select("session_unique_id")))
    assert "Expand" not in s and s.count("Exchange hashpartitioning") <= 3
    assert s.count("Exchange hashpartitioning(item_name") == 1


def test_price_tier_reads_views_once(spark):
    from clickmart.operators.basket import price_tier
    df = price_tier(registry.stg(spark, SF_SMALL))
    df.collect()
    s = plan(df).split("== Initial Plan ==")[0]
    assert "percentile" not in s


def test_cart_uses_semi_join(spark):
    s = plan(cart.cart_abandon(registry.stg(spark, SF_SMALL), cart.abandoned_sessions(registry.feats(spark, SF_SMALL))))
    assert "LeftSemi" in s


def test_top_n_per_category_limits_before_shuffle(spark):
    from clickmart.operators.cart import category_top_n
    df = category_top_n(registry.QUERIES["exclude_items"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan(df)


def test_scan_prunes_columns(spark):
    s = plan(registry.QUERIES["funnel_device"](spark, SF_SMALL))
    assert "ReadSchema" in s
    read = [line for line in s.splitlines() if "ReadSchema" in line]
    assert all("item_price" not in line for line in read)


def test_scale_conf_sizes_partitions():
    from clickmart.conf import scale_conf
    c = scale_conf(100 * 10**12, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) > 300_000
    small = scale_conf(10**9, 2, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
