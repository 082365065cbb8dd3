"""Segment statistics: A33 segment_ci_table, A34 segment_compare, A27/A28
χ² tests on segments, A35 rate-rebuilt conversions.

Input is either session rows (segment label + 0/1 conversion; counted with a
distributed ``groupBy``) or a mart with one row per segment (sessions and a
rounded conversion rate, rebuilt to counts as the dashboard does).  After the
count every frame has one row per segment label, so the pairing of two
segments is a cross join of two one-row frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions import stats
from clickmart.functions.rules import contains_cs

SEG = "segment"


def segment_counts(rows: DataFrame, segment_col: str, converted_col: str = "is_converted",
                   session_col: str = "session_unique_id") -> DataFrame:
    """Exact sessions and conversions per segment (library default)."""
    return rows.groupBy(F.col(segment_col).alias(SEG)).agg(
        F.count(session_col).alias("sessions"),
        F.sum(converted_col).cast("bigint").alias("conversions"),
    ).withColumn("rate", F.col("conversions").cast("double") / F.col("sessions").cast("double"))


def mart_counts(mart: DataFrame, segment_col: str, sessions_col: str = "session_count",
                rate_col: str = "conversion_rate") -> DataFrame:
    """Counts rebuilt from a mart's rounded rate: ``int(n * cvr / 100)`` (Q11)."""
    n = F.col(sessions_col)
    return mart.select(
        F.col(segment_col).alias(SEG),
        n.cast("bigint").alias("sessions"),
        stats.conversions_from_rate(n, F.col(rate_col)).alias("conversions"),
        (F.col(rate_col) / F.lit(100.0)).alias("rate"),
    )


def segment_ci_table(counts: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Sessions, share %, conversions, CVR % and Wilson interval per segment,
    with the error-bar arms (high − cvr, cvr − low)."""
    w = stats.wilson(F.col("conversions"), F.col("sessions"), confidence)
    total = F.sum("sessions").over(Window.partitionBy(F.lit(1)))  # one row per segment label
    out = counts.select(
        SEG, "sessions",
        F.round(F.col("sessions") * F.lit(100.0) / total, 1).alias("share_percent"),
        "conversions",
        w["rate"].alias("cvr"), w["low"].alias("ci_low"), w["high"].alias("ci_high"),
    )
    return out.withColumn("err_plus", F.col("ci_high") - F.col("cvr")) \
              .withColumn("err_minus", F.col("cvr") - F.col("ci_low"))


def _match(pattern: str, regex: bool):
    return F.coalesce(F.col(SEG).rlike(pattern), F.lit(False)) if regex else contains_cs(F.col(SEG), pattern)


def segment_compare(counts: DataFrame, pattern_a: str, pattern_b: str, regex: bool = False,
                    confidence: float = 0.95, yates: bool = True,
                    bands=stats.EFFECT_BANDS, default_label: str = stats.EFFECT_DEFAULT,
                    zero_ratio: float | None = 0.0) -> DataFrame:
    """Two segments side by side: intervals, 2×2 χ² with its p-value and
    text, Cohen's h, label, rate ratio and interval overlap.  One row (none if
    a side is missing).  ``zero_ratio`` is the ratio to a rate of 0."""
    # Both sides from one aggregate over the per-segment rows: the first label
    # (in label order) matching each pattern, as the dashboard takes the first row.
    cols = [SEG, "sessions", "conversions", "rate"]
    row = counts.agg(F.min_by(F.struct(*cols), F.when(_match(pattern_a, regex), F.col(SEG))).alias("a"),
                     F.min_by(F.struct(*cols), F.when(_match(pattern_b, regex), F.col(SEG))).alias("b"))
    pair = row.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).select(
        *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in ("a", "b") for c in cols])
    wa = stats.wilson(F.col("conversions_a"), F.col("sessions_a"), confidence)
    wb = stats.wilson(F.col("conversions_b"), F.col("sessions_b"), confidence)
    h = stats.cohens_h(F.col("rate_a"), F.col("rate_b"))
    chi2 = stats.chi_square_2x2(F.col("conversions_a"), F.col("sessions_a"), F.col("conversions_b"),
                                F.col("sessions_b"), yates)
    ratio = F.when(F.col("rate_b") == 0, F.lit(zero_ratio).cast("double")).otherwise(F.try_divide(F.col("rate_a"), F.col("rate_b")))
    return with_p_value(pair.withColumn("chi2", chi2)).select(
        F.col("segment_a"), F.col("segment_b"),
        "sessions_a", "conversions_a", wa["rate"].alias("cvr_a"), wa["low"].alias("ci_low_a"),
        wa["high"].alias("ci_high_a"),
        "sessions_b", "conversions_b", wb["rate"].alias("cvr_b"), wb["low"].alias("ci_low_b"),
        wb["high"].alias("ci_high_b"),
        "chi2", "p_value", "p_text",
        h.alias("cohens_h"),
        stats.effect_label(h, bands, default_label).alias("effect_label"),
        ratio.alias("rate_ratio"),
        stats.ci_non_overlap(wa["low"], wb["high"]).alias("ci_non_overlap"),
    )


def with_p_value(df: DataFrame, chi2_col: str = "chi2", dof: int | str = 1, digits: int | None = None) -> DataFrame:
    """Adds ``p_value`` (χ² upper tail, rounded to ``digits`` if given) and its display text to the final rows."""
    d = F.col(dof) if isinstance(dof, str) else F.lit(dof)
    p = stats.chi_square_tail(F.col(chi2_col), d)
    out = df.withColumn("p_value", p if digits is None else F.round(p, digits))
    return out.withColumn("p_text", stats.p_text(F.col("p_value")))


def chi_square_segments(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """k×2 χ² over all segments of ``counts`` (per ``by`` group)."""
    return stats.chi_square_kx2(counts, SEG, "conversions", "sessions", by=by)
