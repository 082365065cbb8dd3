"""Statistics of the dashboard as Spark column expressions.

The counting (conversions and sessions per segment) is a distributed
``groupBy``; these functions only do arithmetic on the handful of resulting
rows.  Float operations are written in a fixed order with the constants
pre-computed in Python, so Spark and the DuckDB oracle give the same doubles.
The chi-square tail probability needs ``erfc``, which Spark lacks; it is
expanded into a column expression, so no Python runs on the executors.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases

# Effect-size bands and labels of the segment pages (first code
# block, second code block) and of the written method (0.2 / 0.5 / 0.8).
EFFECT_BANDS = [(0.8, "대형 효과"), (0.5, "중간 효과")]
EFFECT_DEFAULT = "소형 효과"
EFFECT_BANDS_INTENSITY = [(0.8, "대형 효과"), (0.5, "중간~대형 효과")]
EFFECT_DEFAULT_INTENSITY = "소형~중간 효과"
EFFECT_BANDS_METHOD = [(0.8, "large"), (0.5, "medium"), (0.2, "small")]
EFFECT_DEFAULT_METHOD = "negligible"
P_TEXT_THRESHOLD = 0.001
P_TEXT_BELOW = "0.001 미만"


def z_value(confidence: float = 0.95) -> float:
    """Two-sided normal quantile, e.g. 1.959963984540054 for 95 %."""
    return NormalDist().inv_cdf((1.0 + confidence) / 2.0)


def _d(x: float) -> Column:
    return F.lit(float(x)).cast("double")


def wilson(successes: Column, total: Column, confidence: float = 0.95) -> dict[str, Column]:
    """A29 Wilson score interval in percent, clamped to [0, 100]; total 0 -> zeros."""
    z = z_value(confidence)
    z2 = z * z
    n = total.cast("double")
    p = successes.cast("double") / n
    denom = _d(1.0) + _d(z2) / n
    center = (p + _d(z2) / (_d(2.0) * n)) / denom
    margin = _d(z) * F.sqrt((p * (_d(1.0) - p) + _d(z2) / (_d(4.0) * n)) / n) / denom
    empty = total == 0
    return {
        "rate": F.when(empty, _d(0.0)).otherwise(p * _d(100.0)),
        "low": F.when(empty, _d(0.0)).otherwise(F.greatest(_d(0.0), (center - margin) * _d(100.0))),
        "high": F.when(empty, _d(0.0)).otherwise(F.least(_d(100.0), (center + margin) * _d(100.0))),
    }


def cohens_h(p1: Column, p2: Column) -> Column:
    """A30 |2·asin(√p1) − 2·asin(√p2)|."""
    return F.abs(_d(2.0) * F.asin(F.sqrt(p1)) - _d(2.0) * F.asin(F.sqrt(p2)))


def effect_label(h: Column, bands=EFFECT_BANDS, default: str = EFFECT_DEFAULT) -> Column:
    """A31 label of an effect size by descending bands (first band reached wins)."""
    return fold_cases([(h >= t, label) for t, label in bands], default)


def ci_non_overlap(low_a: Column, high_b: Column) -> Column:
    """A32 the intervals do not overlap when the low end of a exceeds the high end of b."""
    return low_a > high_b


def conversions_from_rate(sessions: Column, cvr_percent: Column) -> Column:
    """A35 the dashboard's ``int(sessions * cvr / 100)`` rebuild (Q11)."""
    return (sessions.cast("double") * cvr_percent / _d(100.0)).cast("bigint")


def chi_square_2x2(s1: Column, n1: Column, s2: Column, n2: Column, yates: bool = True) -> Column:
    """A27 χ² of [[s1, n1-s1], [s2, n2-s2]]; Yates-corrected like scipy's default.

    A zero margin gives NULL (scipy raises)."""
    cells = [(s1, n1 - s1), (s2, n2 - s2)]
    r1, r2 = n1.cast("double"), n2.cast("double")
    c1 = (s1 + s2).cast("double")
    c2 = ((n1 - s1) + (n2 - s2)).cast("double")
    total = r1 + r2
    rows, cols = [r1, r2], [c1, c2]
    terms = []
    for i in range(2):
        for j in range(2):
            e = rows[i] * cols[j] / total
            o = cells[i][j].cast("double")
            diff = F.abs(o - e)
            if yates:
                diff = diff - F.least(_d(0.5), diff)
            terms.append(F.try_divide(diff * diff, e))
    chi2 = terms[0] + terms[1] + terms[2] + terms[3]
    zero_margin = (r1 == 0) | (r2 == 0) | (c1 == 0) | (c2 == 0)
    return F.when(zero_margin, F.lit(None).cast("double")).otherwise(chi2)


# Terms and switch point of the error function's two expansions (both at full double precision there).
SERIES_TERMS, FRACTION_TERMS, SERIES_BELOW = 60, 120, 2.0
PI, ROOT_PI, TWO_OVER_ROOT_PI = math.pi, math.sqrt(math.pi), 2.0 / math.sqrt(math.pi)
P_DIGITS = 12


def erfc_root(x: Column) -> Column:
    """erfc(sqrt(x / 2)) for x > 0, the tail for one degree of freedom.

    Below ``SERIES_BELOW`` by the error function's series of positive terms,
    above it by its continued fraction, evaluated from the inside out."""
    half = x / _d(2.0)
    t = F.sqrt(half)

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * x / (_d(2.0) * k + _d(1.0))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    series = F.aggregate(terms, F.struct(t.alias("term"), t.alias("sum")), step, lambda acc: acc["sum"])
    inside_out = F.sequence(F.lit(FRACTION_TERMS), F.lit(1), F.lit(-1))
    fraction = F.aggregate(inside_out, t, lambda c, k: t + (k / _d(2.0)) / c)
    return F.when(t < SERIES_BELOW, _d(1.0) - _d(TWO_OVER_ROOT_PI) * F.exp(-half) * series) \
            .otherwise(F.exp(-half) / (_d(ROOT_PI) * fraction))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """Upper tail of the χ² distribution for whole degrees of freedom, as a column expression.

    NULL for a NULL statistic or fewer than one degree of freedom."""
    half = x / _d(2.0)
    more = F.when(dof < 4, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), (dof / 2).cast("int") - 1))

    def powers(first: Column, factor) -> Column:
        def step(acc: Column, j: Column) -> Column:
            term = acc["term"] * factor(j)
            return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))
        return first * F.aggregate(more, F.struct(_d(1.0).alias("term"), _d(1.0).alias("sum")), step, lambda acc: acc["sum"])

    even = powers(F.exp(-half), lambda j: half / j)
    odd = powers(F.sqrt(_d(2.0) * x / _d(PI)) * F.exp(-half), lambda j: x / (_d(2.0) * j + _d(1.0)))
    tail = F.when(x <= 0, _d(1.0)).when(dof % 2 == 0, even) \
            .otherwise(erfc_root(x) + F.when(dof < 2, _d(0.0)).otherwise(odd))
    return F.when(x.isNull() | dof.isNull() | (dof < 1), F.lit(None).cast("double")).otherwise(tail)


def p_text(p: Column, threshold: float = P_TEXT_THRESHOLD, below: str = P_TEXT_BELOW) -> Column:
    """Display text of a p-value: '<threshold' marker or 4 decimals."""
    return F.when(p < threshold, F.lit(below)).otherwise(F.format_number(p, 4))


def chi_square_kx2(counts: DataFrame, segment_col: str, success_col: str, total_col: str,
                   yates_if_dof1: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """A28 χ² over k segments × (converted, not converted); one output row
    (per ``by`` group when several tests are computed together).

    ``counts`` holds one row per segment (k is the number of segment labels).
    Totals come from a one-row aggregate per test; terms are added in segment
    order with a left fold, so the sum is deterministic."""
    by = tuple(by)
    # Totals over the segment rows of each test (k rows): a window, no join.
    w = Window.partitionBy(*[F.col(c) for c in by]) if by else Window.partitionBy(F.lit(1))
    cells = counts.select(
        "*",
        F.sum(success_col).over(w).cast("double").alias("_c1"),
        F.sum(F.col(total_col) - F.col(success_col)).over(w).cast("double").alias("_c2"),
        F.sum(total_col).over(w).cast("double").alias("_n"),
        F.count(F.lit(1)).over(w).alias("_k"),
    )
    row_n = F.col(total_col).cast("double")
    o1 = F.col(success_col).cast("double")
    o2 = (F.col(total_col) - F.col(success_col)).cast("double")
    e1 = row_n * F.col("_c1") / F.col("_n")
    e2 = row_n * F.col("_c2") / F.col("_n")
    d1, d2 = F.abs(o1 - e1), F.abs(o2 - e2)
    if yates_if_dof1:
        one = F.col("_k") == 2
        d1 = F.when(one, d1 - F.least(_d(0.5), d1)).otherwise(d1)
        d2 = F.when(one, d2 - F.least(_d(0.5), d2)).otherwise(d2)
    term = F.try_divide(d1 * d1, e1) + F.try_divide(d2 * d2, e2)
    per_seg = cells.select(*by, F.col(segment_col).alias("_seg"), term.alias("_term"), "_k",
                           ((F.col("_c1") == 0) | (F.col("_c2") == 0) | (F.col(total_col) == 0)).alias("_z"))
    zero = "_z"
    out = per_seg.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("_seg", "_term"))).alias("_terms"),
        F.max("_k").alias("_k"),
        F.max(F.col(zero).cast("int")).alias("_zero"),
    )
    chi2 = F.aggregate("_terms", _d(0.0), lambda acc, x: acc + x["_term"])
    return out.select(
        *by,
        # no segment at all, or a zero margin: undefined (NULL)
        F.when((F.col("_zero") == 1) | F.col("_k").isNull(), F.lit(None).cast("double")).otherwise(chi2)
        .alias("chi2"),
        (F.col("_k") - 1).cast("int").alias("dof"),
        F.col("_k").cast("int").alias("segments"),
    )
