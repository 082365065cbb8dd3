import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.operators import friction, funnel, promo, scoring, segments, sessions
from clickmart.operators.staging import stage_events
from fixtures import ev, frame, item


def staged(spark, rows):
    return stage_events(frame(spark, rows))


def test_session_funnel_min_hour_and_weekday_quirk(spark):
    # Saturday 2024-01-06 23:50 -> Sunday 00:20: min hour 0, min weekday 1 (Sunday)
    rows = [ev("2024-01-06 23:50:00", "session_start", gsid=1),
            ev("2024-01-06 23:55:00", "view_item", gsid=1, items=[item("A")]),
            ev("2024-01-07 00:20:00", "purchase", gsid=1, txn="T1", revenue=30.0, items=[item("A")])]
    s = sessions.session_funnel(staged(spark, rows)).collect()[0]
    assert (s.session_hour, s.session_day_of_week) == (0, 1)
    assert (s.has_session_start, s.has_view_item, s.has_add_to_cart, s.has_purchase, s.revenue) == (1, 1, 0, 1, 30.0)
    assert str(s.session_start_at).startswith("2024-01-06 23:50")


def test_paths_tie_break_and_null_session(spark):
    rows = [ev("2024-01-05 10:00:00", "view_item", gsid=1, event_id=2, items=[item("A"), item("B")]),
            ev("2024-01-05 10:00:00", "session_start", gsid=1, event_id=1),
            ev("2024-01-05 10:05:00", "purchase", gsid=1, event_id=3, txn="T", items=[item("A")]),
            ev("2024-01-05 11:00:00", "page_view", user="x", gsid=None, event_id=4),
            ev("2024-01-05 11:00:00", "page_view", user="y", gsid=None, event_id=5)]
    stg = staged(spark, rows)
    p = {r.session_unique_id: r for r in sessions.session_paths(stg).collect()}
    assert p["u1-1"].full_path == "session_start > view_item > view_item > purchase"
    assert (p["u1-1"].path_length, p["u1-1"].is_converted) == (4, 1)
    assert p[None].path_length == 2
    # the NULL session is one session for the session-level models ...
    assert sessions.session_funnel(stg).count() == 2
    # ... and one row per user for the score model, which groups by (session, user)
    assert scoring.engage_lift_score(sessions.session_features(stg)).count() == 3


def test_percent_rank_matches_window_and_boundaries(spark):
    random.seed(7)
    rows = [(f"s{i}", "u", random.choice([1, 2, 3, 5, 8, 13, 21])) for i in range(300)]
    df = spark.createDataFrame(rows, "session_unique_id string, user_pseudo_id string, engagement_score long")
    ours = scoring.percent_rank_desc(df, "engagement_score").select("session_unique_id", "pct_rank")
    ref = df.select("session_unique_id",
                    F.percent_rank().over(Window.orderBy(F.desc("engagement_score"))).alias("ref"))
    bad = ours.join(ref, "session_unique_id").filter(F.col("pct_rank") != F.col("ref")).count()
    assert bad == 0
    # 11 distinct scores: ranks 0, .1, ..., 1.0 -> High up to 0.2 inclusive, Medium up to 0.5
    df11 = spark.createDataFrame([(f"s{i}", "u", 100 - i) for i in range(11)],
                                 "session_unique_id string, user_pseudo_id string, engagement_score long")
    grades = [r.engagement_grade for r in scoring.engage_lift_score(df11).orderBy(F.desc("engagement_score")).collect()]
    assert grades == ["High Intent"] * 3 + ["Medium Intent"] * 3 + ["Low Intent"] * 5
    one = df11.limit(1)
    assert scoring.engage_lift_score(one).collect()[0].engagement_grade == "High Intent"


def test_score_weights(spark):
    rows = [ev("2024-01-05 10:00:00", n, gsid=1) for n in
            ["view_item", "view_search_results", "add_to_cart", "begin_checkout", "add_payment_info", "page_view"]]
    f = sessions.session_features(staged(spark, rows)).collect()[0]
    assert f.engagement_score == 5 + 3 + 12 + 31 + 47 + 1
    assert f.engagement_score_short == 5 + 1 + 12 + 31 + 47 + 1


def test_browsing_styles(spark):
    rows = []
    # light: 2 items; deep: 3 items one category; variety: 3 items two categories; others: 3 items NULL categories
    rows += [ev("2024-01-05 10:00:00", "view_item", gsid=1, items=[item("A"), item("B")])]
    rows += [ev("2024-01-05 10:00:00", "view_item", gsid=2, items=[item("A"), item("B"), item("C")])]
    rows += [ev("2024-01-05 10:00:00", "view_item", gsid=3,
                items=[item("A"), item("B", category="Home/Bags/"), item("C")])]
    rows += [ev("2024-01-05 10:00:00", "view_item", gsid=4,
                items=[item("A", category=None), item("B", category=None), item("C", category=None)])]
    rows += [ev("2024-01-05 10:00:00", "page_view", gsid=5)]  # no items viewed: not segmented
    st = segments.browsing_style(sessions.session_level(sessions.session_features(staged(spark, rows))))
    got = {r.session_unique_id: r.browsing_style for r in st.collect()}
    assert got == {"u1-1": segments.LIGHT, "u1-2": segments.DEEP, "u1-3": segments.VARIETY, "u1-4": segments.OTHERS}


def test_coverage_ignores_the_null_session(spark):
    rows = [ev("2024-01-05 10:00:00", "view_item", gsid=1, items=[item("A")]), ev("2024-01-05 10:00:00", "view_item", gsid=None, items=[item("A")])]
    level = sessions.session_level(sessions.session_features(staged(spark, rows)))
    got = segments.segment_coverage(level).collect()[0]
    assert (got.segment_sessions, got.total_sessions, got.coverage_percent) == (1, 2, 50.0)
    assert sum(r.session_count for r in segments.browsing_style_summary(segments.browsing_style(level)).collect()) == 1


def test_core_sessions_from_staged_rows_equal_those_from_paths(spark):
    rows = [ev(f"2024-01-05 10:0{m}:00", n, gsid=g) for g in (1, 2, None) for m, n in enumerate(["view_item", "add_to_cart", "purchase"][:g or 3])]
    stg = staged(spark, rows)
    f = sessions.session_features(stg)
    a = scoring.core_sessions(f, sessions.session_paths(stg)).collect()
    assert sorted(map(str, a)) == sorted(map(str, scoring.core_sessions(f, stg=stg).collect()))


def test_depth_and_intensity_buckets(spark):
    items = F.col("n")
    df = spark.createDataFrame([(n,) for n in [3, 11, 12, 24, 25, 36, 37, 84, 85]], "n long")
    d = [r[0] for r in df.select(segments.depth_bucket(items)).collect()]
    i = [r[0] for r in df.select(segments.intensity_bucket(items)).collect()]
    assert d == [segments.DEPTH_SEGMENTS[k] for k in [0, 0, 1, 1, 2, 2, 3, 3, 3]]
    assert i == [segments.INTENSITY_SEGMENTS[k] for k in [0, 0, 0, 0, 1, 1, 2, 2, 3]]


def test_time_to_conversion_buckets(spark):
    rows = []
    for g, m in enumerate([4, 5, 14, 15, 29, 30, 59, 60], start=1):
        rows.append(ev("2024-01-05 10:00:00", "session_start", gsid=g))
        rows.append(ev(f"2024-01-05 {10 + m // 60:02d}:{m % 60:02d}:30", "purchase", gsid=g, txn=f"T{g}",
                       items=[item("A", price=2.0, quantity=g)]))
    out = friction.time_to_conversion(sessions.session_level(sessions.session_features(staged(spark, rows))))
    got = sorted((r.minutes_to_buy, r.time_bucket, r.session_count, r.avg_order_value) for r in out.collect())
    labels = [b for _, b in friction.TIME_BUCKETS] + [friction.TIME_BUCKET_LAST]
    assert [g[1] for g in got] == [labels[0], labels[1], labels[1], labels[2], labels[2], labels[3], labels[3], labels[4]]
    assert [g[0] for g in got] == [4, 5, 14, 15, 29, 30, 59, 60]
    assert got[0][3] == 2.0


def test_empty_funnel_ratios_are_null(spark):
    empty = sessions.session_level(sessions.session_features(staged(spark, [ev("2024-01-05 10:00:00", "x")]).limit(0)))
    row = funnel.funnel_overall(empty).collect()[0]
    assert row.total_sessions == 0 and row.pct_view is None
    assert [r.conversion_rate for r in funnel.open_funnel(empty).collect()] == [1.0, None, None, None]


def test_promo_threshold_and_source_threshold(spark):
    rows = []
    for i in range(51):
        rows.append(ev("2024-01-05 10:00:00", "view_promotion", gsid=i, items=[item(None, None, None, None, promo="P51")]))
    for i in range(50):
        rows.append(ev("2024-01-05 10:00:00", "view_promotion", gsid=100 + i, items=[item(None, None, None, None, promo="P50")]))
    rows.append(ev("2024-01-05 10:00:00", "select_promotion", gsid=1, items=[item(None, None, None, None, promo="P51")]))
    stg = staged(spark, rows)
    perf = {r.promotion_name: r for r in promo.promo_performance(stg).collect()}
    assert set(perf) == {"P51"} and perf["P51"].ctr_percent == round(1 / 51 * 100, 2)
    src = funnel.funnel_source(sessions.session_level(sessions.session_features(stg)))
    got = [(r.source, r.medium, r.sessions) for r in src.collect()]
    assert got == [("(direct)", "(none)", 101)]
    assert funnel.funnel_source(sessions.session_level(sessions.session_features(stg)), min_sessions=102).count() == 0
