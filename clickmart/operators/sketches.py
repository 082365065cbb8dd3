"""Mergeable daily states: approximate quantiles (KLL) and distinct counts (HyperLogLog) without old days.

A day's staged rows become one small row of binary sketches for each day (and
style).  Cut-offs, quantiles and distinct sessions of any range of days come
from merging these rows; the staged rows of earlier days are not read again.
Item averages need no sketch: sums and counts by (day, item) merge exactly.

A KLL sketch of size k gives a quantile whose normalised rank is off by more
than 2.296 / k**0.9723 in about one of a hundred cases; ``rank_bound`` is three
times that.  The relative standard error of a merged HyperLogLog sketch is
about 1.04 / sqrt(2**lg_k); ``distinct_bound`` is four times that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, safe_div
from clickmart.operators.basket import HIGH, LOW, MID
from clickmart.operators.funnel import OPEN_FUNNEL_STEPS
from clickmart.operators.segments import QUANTILES, _share

DAY = "event_date"
KLL_K, HLL_LG_K = 1000, 14
CUT_OFFS = (0.33, 0.66)


def rank_bound(k: int = KLL_K) -> float:
    return 3 * 2.296 / k ** 0.9723


def distinct_bound(lg_k: int = HLL_LG_K) -> float:
    return 4 * 1.04 / 2 ** (lg_k / 2)


# ------------------------------------------------------------------ prices
def _viewed(stg: DataFrame) -> DataFrame:
    return stg.where((F.col("event_name") == "view_item") & (F.col("item_price") > 0)).select(DAY, "item_name", "item_price")


def daily_price_sketches(stg: DataFrame, k: int = KLL_K) -> DataFrame:
    """One row for each day: views with a price, and the sketch of their prices."""
    return _viewed(stg).groupBy(DAY).agg(F.count(F.lit(1)).alias("views"), F.kll_sketch_agg_double("item_price", F.lit(k)).alias("prices"))


def daily_item_prices(stg: DataFrame) -> DataFrame:
    """(day, item): the sum of viewed prices and their number."""
    return _viewed(stg).groupBy(DAY, "item_name").agg(F.sum("item_price").alias("price_sum"), F.count(F.lit(1)).alias("views"))


def price_cutoffs_from_sketches(days: DataFrame, quantiles: Sequence[float] = CUT_OFFS) -> DataFrame:
    """One row from the sketches of ``days``: their number, views, and an array of the prices at ``quantiles`` (NULL without views)."""
    merged = days.agg(F.count(F.lit(1)).alias("n_days"), F.coalesce(F.sum("views"), F.lit(0)).alias("n_views"), F.kll_merge_agg_double("prices").alias("m"))
    at = F.array(*[F.kll_sketch_get_quantile_double("m", F.lit(float(q))) for q in quantiles])
    return merged.select("n_days", "n_views", F.when(F.col("n_views") > 0, at).alias("cutoffs"))


def price_tier_from_state(items: DataFrame, days: DataFrame, quantiles: Sequence[float] = CUT_OFFS) -> DataFrame:
    """A07 from the daily states: item averages are exact, the two cut-offs are within ``rank_bound`` of their ranks."""
    cuts = price_cutoffs_from_sketches(days, quantiles).select("cutoffs").scalar()
    average = items.groupBy("item_name").agg(F.try_divide(F.sum("price_sum"), F.sum("views")).alias("avg_price"))
    priced = average.withColumn("c", cuts).select("item_name", "avg_price", F.col("c")[0].alias("p33_cutoff"), F.col("c")[1].alias("p66_cutoff"))
    tier = fold_cases([(F.col("avg_price") >= F.col("p66_cutoff"), HIGH), (F.col("avg_price") >= F.col("p33_cutoff"), MID)], LOW)
    return priced.select("item_name", "avg_price", tier.alias("price_tier"), "p33_cutoff", "p66_cutoff")


def _reached(value: Column, cut: Column, n: Column) -> tuple[Column, Column]:
    """Shares of the values below a cut-off and up to it."""
    return (F.sum(F.when(value < cut, n).otherwise(0)) / F.sum(n), F.sum(F.when(value <= cut, n).otherwise(0)) / F.sum(n))


def _rank_error(q: float, below: Column, upto: Column) -> Column:
    """How far the ranks that a value has lie from the asked one; 0 if it has that rank."""
    return F.greatest(F.lit(0.0), below - F.lit(float(q)), F.lit(float(q)) - upto)


def price_cutoff_errors(stg: DataFrame, days: DataFrame, quantiles: Sequence[float] = CUT_OFFS, k: int = KLL_K) -> DataFrame:
    """One row for each quantile: the sketches' cut-off and its exact rank error, counted over all staged rows."""
    cuts = price_cutoffs_from_sketches(days, quantiles).select(F.struct("*").alias("s")).scalar()
    counted = _viewed(stg).groupBy("item_price").agg(F.count(F.lit(1)).alias("n")).withColumn("s", cuts)
    found = counted.agg(F.sum("n").alias("exact_views"), F.first("s").alias("s"), *[
        F.struct(*[c.alias(name) for c, name in zip(_reached(F.col("item_price"), F.col("s.cutoffs")[i], F.col("n")), ("below", "upto"))]).alias(f"r{i}")
        for i in range(len(quantiles))])
    rows = F.explode(F.array(*[F.struct(
        F.lit(float(q)).alias("quantile"), F.col("s.cutoffs")[i].alias("cutoff"),
        _rank_error(q, F.col(f"r{i}.below"), F.col(f"r{i}.upto")).alias("rank_error")) for i, q in enumerate(quantiles)])).alias("r")
    return (found.where("exact_views > 0").select(F.col("s.n_days").alias("n_days"), F.col("s.n_views").alias("n_views"), rows)
            .select("n_days", "n_views", "r.*", F.lit(rank_bound(k)).alias("rank_bound")))


# ------------------------------------------------------------------ styles
def daily_style_sketches(styles: DataFrame, sessions: DataFrame, k: int = KLL_K) -> DataFrame:
    """(day a session began, style): sessions, items viewed, conversions, and the sketch of the items viewed.

    ``styles`` is A04; ``sessions`` tells when each began.  A session that
    goes on after midnight stays with its first day, whose row is then rebuilt.
    """
    began = sessions.select(F.col("session_unique_id").alias("_sid"), F.date_format("session_start_at", "yyyyMMdd").alias(DAY))
    dated = styles.join(began, F.col("session_unique_id").eqNullSafe(F.col("_sid")))
    return dated.groupBy(DAY, "browsing_style").agg(
        F.count("session_unique_id").alias("sessions"), F.count(F.lit(1)).alias("rows"), F.sum("total_items_viewed").alias("items"),
        F.sum("is_converted").cast("bigint").alias("converted"), F.kll_sketch_agg_bigint("total_items_viewed", F.lit(k)).alias("viewed"))


def style_summary_from_sketches(days: DataFrame, quantiles: Sequence[int] = QUANTILES) -> DataFrame:
    """A12 from the daily states: counts, averages and rates are exact, quantiles are the sketches'."""
    merged = days.groupBy("browsing_style").agg(
        F.sum("sessions").alias("session_count"), F.sum("rows").alias("rows"), F.sum("items").alias("items"), F.sum("converted").alias("converted"),
        F.kll_merge_agg_bigint("viewed").alias("m"))
    at = [F.kll_sketch_get_quantile_bigint("m", F.lit(q / 100)).cast("double").alias(f"item_viewed_p{q}") for q in quantiles]
    return merged.select(
        "browsing_style", "session_count", _share("session_count").alias("session_share_percent"),
        F.round(F.col("items") / F.col("rows"), 3).alias("avg_items_viewed"), *at,
        F.round(F.col("converted") / F.col("rows") * F.lit(100.0), 3).alias("conversion_rate"))


def style_quantile_errors(styles: DataFrame, days: DataFrame, quantiles: Sequence[int] = QUANTILES, k: int = KLL_K) -> DataFrame:
    """(style, quantile): the sketches' value and its exact rank error, counted over all styled sessions."""
    made = style_summary_from_sketches(days, quantiles).select("browsing_style", *[f"item_viewed_p{q}" for q in quantiles])
    counted = styles.groupBy("browsing_style", "total_items_viewed").agg(F.count(F.lit(1)).alias("n")).join(made, "browsing_style")
    found = counted.groupBy("browsing_style").agg(F.sum("n").alias("sessions"), *[F.struct(
        F.first(f"item_viewed_p{q}").alias("value"),
        *[c.alias(name) for c, name in zip(_reached(F.col("total_items_viewed"), F.col(f"item_viewed_p{q}"), F.col("n")), ("below", "upto"))]).alias(f"r{q}") for q in quantiles])
    rows = F.explode(F.array(*[F.struct(
        F.lit(q).alias("percent"), F.col(f"r{q}.value").alias("items_viewed"),
        _rank_error(q / 100, F.col(f"r{q}.below"), F.col(f"r{q}.upto")).alias("rank_error")) for q in quantiles])).alias("r")
    return found.select("browsing_style", "sessions", rows).select("browsing_style", "sessions", "r.*", F.lit(rank_bound(k)).alias("rank_bound"))


# ------------------------------------------------------------------ distinct sessions
def _step_event(column: str) -> Column:
    """Whether a staged row counts for a step of the open funnel."""
    return F.lit(True) if column == "sessions" else F.col("event_name") == column.removeprefix("has_")


def daily_session_sketches(stg: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """One row for each day: a sketch of the distinct sessions that reached each step of the open funnel."""
    return stg.groupBy(DAY).agg(*[
        F.hll_sketch_agg(F.when(_step_event(column), F.col("session_unique_id")), F.lit(lg_k)).alias(column) for _, _, column in OPEN_FUNNEL_STEPS])


def open_funnel_from_sketches(days: DataFrame) -> DataFrame:
    """A22 from the daily sketches: a session counts once however many days it is in; also the number of days."""
    merged = days.agg(F.count(F.lit(1)).alias("n_days"), *[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(column)), F.lit(0)).cast("bigint").alias(column) for _, _, column in OPEN_FUNNEL_STEPS])
    steps = []
    for i, (order, name, column) in enumerate(OPEN_FUNNEL_STEPS):
        rate = safe_div(F.col(column), F.col(OPEN_FUNNEL_STEPS[i - 1][2])) if i else None
        steps.append(F.struct(F.lit(name).alias("step_name"), F.lit(order).alias("step_order"), F.col(column).alias("user_count"),
                              (F.round(rate, 4) if i else F.lit(1.0)).alias("conversion_rate"),
                              (F.round(F.lit(1.0) - rate, 4) if i else F.lit(0.0)).alias("drop_off_rate")))
    return merged.select("n_days", F.explode(F.array(*steps)).alias("r")).select("n_days", "r.*")


def open_funnel_errors(exact: DataFrame, days: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """Each step's exact count (``exact`` is A22), the sketches' estimate and its relative error."""
    made = open_funnel_from_sketches(days).select("n_days", "step_order", F.col("user_count").alias("estimate"))
    error = F.coalesce(F.try_divide(F.abs(F.col("estimate") - F.col("user_count")).cast("double"), F.col("user_count").cast("double")),
                       F.col("estimate").cast("double"))
    return exact.select("step_order", "step_name", "user_count").join(made, "step_order").select(
        "step_order", "step_name", "n_days", "user_count", "estimate", error.alias("relative_error"), F.lit(distinct_bound(lg_k)).alias("error_bound"))
