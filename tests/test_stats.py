"""Golden statistics: inputs are the published per-segment rows (sessions and
rounded conversion rate); expected values re-derived independently."""

import math

import pytest
from pyspark.sql import functions as F

from clickmart.functions import stats
from clickmart.operators import significance

REL = 1e-9

STYLES = [("Variety Seeker (다양성 추구형)", 13091, 13.024), ("Light Browser", 532, 5.451),
          ("Deep Specialist (한우물형)", 8898, 2.551)]
DEPTH = [("1. 탐색 초기 (3-11개)", 678, 44), ("2. 집중 비교 (12-24개)", 7244, 136),
         ("3. 고민 심화 (25-36개)", 539, 25), ("4. 결정 마비 (37개 이상)", 437, 21)]
INTENSITY = [("1. Light Seeker (24개 이하)", 4707, 184), ("2. Moderate Seeker (25-36개)", 1922, 108),
             ("3. Heavy Seeker (37-84개)", 3214, 386), ("4. Super Heavy Seeker (85개 이상)", 3248, 1024)]


def close(a, b, rel=REL):
    return math.isclose(a, b, rel_tol=rel)


def mart(spark, rows):
    return spark.createDataFrame(rows, "segment string, session_count long, conversion_rate double")


def counts(spark, rows):
    return spark.createDataFrame([(s, n, c, c / n) for s, n, c in rows],
                                 "segment string, sessions long, conversions long, rate double")


def test_wilson_intervals_from_rebuilt_counts(spark):
    c = significance.mart_counts(mart(spark, STYLES), "segment")
    got = {r.segment: r for r in significance.segment_ci_table(c).collect()}
    v, l, d = got[STYLES[0][0]], got[STYLES[1][0]], got[STYLES[2][0]]
    assert (v.conversions, l.conversions, d.conversions) == (1704, 28, 226)
    assert close(v.ci_low, 12.451002288084814) and close(v.ci_high, 13.603848926035662)
    assert close(l.ci_low, 3.6662114565233175) and close(l.ci_high, 7.501543079005925)
    assert close(d.ci_low, 2.232900450668914) and close(d.ci_high, 2.8878541811607517)
    assert v.ci_low <= v.cvr <= v.ci_high and close(v.err_plus, v.ci_high - v.cvr)


def test_wilson_zero_total_and_clamp(spark):
    df = spark.createDataFrame([(0, 0), (5, 5), (0, 5)], "s long, n long")
    w = stats.wilson(F.col("s"), F.col("n"))
    rows = df.select(w["rate"], w["low"], w["high"]).collect()
    assert tuple(rows[0]) == (0.0, 0.0, 0.0)
    assert rows[1][2] <= 100.0 and rows[2][1] >= 0.0


def test_chi_square_2x2_and_compare(spark):
    c = significance.mart_counts(mart(spark, STYLES), "segment")
    r = significance.segment_compare(c, "Variety", "Deep").collect()[0]
    assert close(r.chi2, 724.8840838181974)
    assert close(r.cohens_h, 0.41762835371651585)
    assert close(r.rate_ratio, 5.105448843590748)
    assert close(r.p_value, 1.1604592596511883e-159, 1e-6) and r.p_text == stats.P_TEXT_BELOW
    assert r.effect_label == stats.EFFECT_DEFAULT and r.ci_non_overlap is True
    p = significance.with_p_value(c.limit(0).select(F.lit(r.chi2).alias("chi2")).union(
        spark.createDataFrame([(r.chi2,)], "chi2 double")), "chi2", 1).collect()[0]
    assert close(p.p_value, 1.1604592596511883e-159, 1e-6) and p.p_text == stats.P_TEXT_BELOW
    exact = spark.createDataFrame([(1705, 13091, 227, 8898)], "a long, n long, b long, m long")
    y, u = exact.select(stats.chi_square_2x2(F.col("a"), F.col("n"), F.col("b"), F.col("m")),
                        stats.chi_square_2x2(F.col("a"), F.col("n"), F.col("b"), F.col("m"), yates=False)).collect()[0]
    assert close(y, 723.7078760884095) and close(u, 725.0140967229507)
    reb = spark.createDataFrame([(1704, 13091, 226, 8898)], "a long, n long, b long, m long")
    u2 = reb.select(stats.chi_square_2x2(F.col("a"), F.col("n"), F.col("b"), F.col("m"), yates=False)).collect()[0][0]
    assert close(u2, 726.1919772533494)


def test_chi_square_small_matches_mllib(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest
    df = spark.createDataFrame([(30, 100, 10, 100)], "a long, n long, b long, m long")
    ours = df.select(stats.chi_square_2x2(F.col("a"), F.col("n"), F.col("b"), F.col("m"), yates=False)).collect()[0][0]
    assert close(ours, 12.5)
    rows = [(0.0, Vectors.dense([1.0]))] * 30 + [(0.0, Vectors.dense([0.0]))] * 70 + \
           [(1.0, Vectors.dense([1.0]))] * 10 + [(1.0, Vectors.dense([0.0]))] * 90
    ml = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]), "features", "label").collect()[0]
    assert close(float(ml.statistics[0]), ours)


@pytest.mark.parametrize("rows,chi2,p", [
    (DEPTH, 74.22214270847726, 5.318763357700601e-16),
    (INTENSITY, 1424.9464656759994, None),
])
def test_chi_square_kx2(spark, rows, chi2, p):
    out = significance.chi_square_segments(counts(spark, rows))
    r = significance.with_p_value(out, "chi2", "dof").collect()[0]
    assert close(r.chi2, chi2) and r.dof == 3
    if p is not None:
        assert close(r.p_value, p, 1e-6)
    else:
        assert r.p_value < 1e-300


def test_chi2_tail(spark):
    # quantiles of the 5 % tail, closed forms, and the error function over its whole range
    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251178, 3, 0.05),
             (9.487729036781154, 4, 0.05), (11.070497693516351, 5, 0.05), (0.0, 3, 1.0)]
    cases += [(x, 1, math.erfc(math.sqrt(x / 2))) for x in (1e-6, 0.1, 1.0, 4.0, 7.9, 7.999, 8.0, 8.001, 9.0, 30.0, 700.0)]
    cases += [(x, 2, math.exp(-x / 2)) for x in (0.5, 20.0)]
    df = spark.createDataFrame([(float(x), d, p) for x, d, p in cases], "x double, dof int, p double")
    for r in df.withColumn("got", stats.chi_square_tail(F.col("x"), F.col("dof"))).collect():
        assert close(r.got, r.p, 1e-9), r
    none = spark.createDataFrame([(None, 1), (1.0, None), (1.0, 0)], "x double, dof int")
    assert all(r[0] is None for r in none.select(stats.chi_square_tail(F.col("x"), F.col("dof"))).collect())
    assert "Python" not in none.select(stats.chi_square_tail(F.col("x"), F.col("dof")))._jdf.queryExecution().toString()


def test_rate_ratio_to_zero(spark):
    c = counts(spark, [("a", 10, 5), ("b", 10, 0)])
    assert significance.segment_compare(c, "a", "b").collect()[0].rate_ratio == 0.0
    assert significance.segment_compare(c, "a", "b", zero_ratio=None).collect()[0].rate_ratio is None


def test_intensity_compare_labels(spark):
    c = counts(spark, INTENSITY)
    r = significance.segment_compare(c, "Super Heavy|85", "Light|24개 이하", regex=True,
                                     bands=stats.EFFECT_BANDS_INTENSITY,
                                     default_label=stats.EFFECT_DEFAULT_INTENSITY).collect()[0]
    assert r.segment_a.startswith("4.") and r.segment_b.startswith("1.")
    assert r.effect_label == "중간~대형 효과"
    h = spark.createDataFrame([(0.3153, 0.0393)], "a double, b double").select(
        stats.cohens_h(F.col("a"), F.col("b"))).collect()[0][0]
    assert close(h, 0.7933044994931413)
    assert close(31.53 / 3.93, 8.022900763358779)


def test_kpi_and_coverage_arithmetic(spark):
    from clickmart.operators import funnel
    fo = spark.createDataFrame([(133368, 8450, 2116, 1.59)],
                               "total_sessions long, step2_add_to_cart long, step5_purchase long, pct_purchase double")
    k = funnel.kpi_summary(fo).collect()[0]
    assert close(k.bounce_rate, 98.41341251274669) and close(k.cvr_rate, 1.586587487253314)
    assert k.cart_add_rate == 6.3
    assert close(22521 / 133368 * 100, 16.886359546517905)


def test_effect_label_bands(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.5,), (0.8,)], "h double")
    got = [r[0] for r in df.select(stats.effect_label(F.col("h"), stats.EFFECT_BANDS_METHOD,
                                                      stats.EFFECT_DEFAULT_METHOD)).collect()]
    assert got == ["negligible", "small", "medium", "large"]
