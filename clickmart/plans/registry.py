"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the driver tables of ``sf_dir`` (events, lineitem,
part), derives the nested events and the staged rows on Spark, and runs one
operator over the whole of them.  ``plans/oracle.py`` has the SQL of each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.conf import ensure_checkpoint_dir
from clickmart.functions import stats as ST
from clickmart.operators import basket, cart, friction, funnel, promo, scoring, segments, sessions, significance, sketches
from clickmart.operators.staging import stage_events, staged_from_tables
from clickmart.plans import materialize
from clickmart.plans.incremental import facts_in_halves
from clickmart.plans.materialize import source_signature
from clickmart.plans.oracle import ORACLE  # noqa: F401
from clickmart.sources import io
from clickmart.sources.binding import nested_events, read_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SOURCE_TABLES = ("events", "lineitem", "part")


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _model(name: str, build: Callable[[], DataFrame], spark: SparkSession, sf_dir: str, **layout) -> DataFrame:
    """An upstream model as a written table, built once per source snapshot."""
    signature = source_signature(spark, [f"{sf_dir}/{t}.parquet" for t in SOURCE_TABLES])
    return materialize.table(spark, name, signature, build, **layout)


# ------------------------------------------------------------------ upstream models
def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows, partitioned by date and sorted by event name within a file."""
    return _model("stg_events", lambda: staged_from_tables(spark, sf_dir, arrange=True), spark, sf_dir,
                  partition_by=["event_date"], arranged=True)


def feats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fused session aggregate (survey P1)."""
    return _model("session_features", lambda: sessions.session_features(stg(spark, sf_dir)), spark, sf_dir)


def sess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session-grain rows (A02's grain, NULL session merged)."""
    return _model("session_level", lambda: sessions.session_level(feats(spark, sf_dir)), spark, sf_dir)


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A06 scores and grades, with the session's conversion flag."""
    return _model("engage_lift_score", lambda: scoring.engage_lift_score(feats(spark, sf_dir), keep=["has_purchase"]), spark, sf_dir)


def styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A04 browsing styles."""
    return _model("browsing_style", lambda: segments.browsing_style(sess(spark, sf_dir)), spark, sf_dir)


def tiers_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07 price tiers."""
    return _model("price_tier", lambda: basket.price_tier(stg(spark, sf_dir)), spark, sf_dir)


def paths_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A03 paths."""
    return _model("session_paths", lambda: sessions.session_paths(stg(spark, sf_dir)), spark, sf_dir)


def price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price sketches by day."""
    return _model("price_sketches", lambda: sketches.daily_price_sketches(stg(spark, sf_dir)), spark, sf_dir, partition_by=["event_date"])


def item_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of viewed prices by day and item."""
    return _model("item_prices", lambda: sketches.daily_item_prices(stg(spark, sf_dir)), spark, sf_dir, partition_by=["event_date"])


def style_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of items viewed by the day a session began and its style."""
    return _model("style_sketches", lambda: sketches.daily_style_sketches(styles(spark, sf_dir), sess(spark, sf_dir)), spark, sf_dir, partition_by=["event_date"])


def session_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of distinct sessions by day and funnel step."""
    return _model("session_sketches", lambda: sketches.daily_session_sketches(stg(spark, sf_dir)), spark, sf_dir, partition_by=["event_date"])


def cart_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, which the dashboard rollups A38-A45 read."""
    return _model("cart_abandon", lambda: cart_abandon(spark, sf_dir), spark, sf_dir)


def cart_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cart.exclude_items(cart_mart(spark, sf_dir))


def quality_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24, which the summary views A46 and A47 read."""
    return _model("promo_quality", lambda: promo_quality(spark, sf_dir), spark, sf_dir)


UPSTREAM = (stg, feats, sess, graded, styles, paths_table, tiers_table, price_days, item_days, style_days, session_days, cart_mart, quality_mart)


# ------------------------------------------------------------------ staging and sessions
# The staging model itself always runs in full: binding and flattening of the raw tables.
QUERIES["stage_events"] = staged_from_tables


@register
def session_funnel(spark, sf_dir):
    return sessions.session_funnel(sessions=sessions.session_level(feats(spark, sf_dir)))


@register
def session_paths(spark, sf_dir):
    return sessions.session_paths(stg(spark, sf_dir))


@register
def session_path_pieces(spark, sf_dir):
    """A03 in pieces of time, of which none grows with its session."""
    return sessions.session_path_pieces(stg(spark, sf_dir))


@register
def session_facts_incremental(spark, sf_dir):
    """The session facts built from two halves of the days, the second as an update; A02 and the sums of each session."""
    return facts_in_halves(stg(spark, sf_dir), f"{ensure_checkpoint_dir(spark).rstrip('/')}/clickmart-facts-{uuid.uuid4().hex}")


@register
def events_export_roundtrip(spark, sf_dir):
    """Nested events written as daily shards to the shared folder, read back from the first shard to the last and staged."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clickmart-export-{uuid.uuid4().hex}"
    io.write_events(nested_events(spark, sf_dir), path)
    shards = io.shard_dates(spark, path)
    staged = stage_events(io.read_events(spark, path, shards[0], shards[-1]) if shards else io.read_events(spark, path))
    return staged.groupBy("event_date").agg(F.count(F.lit(1)).alias("staged_rows"), F.count_distinct("event_id").alias("events"),
                                            F.sum("item_revenue_calc").alias("revenue"))


# ------------------------------------------------------------------ funnels
for _name in ("funnel_overall", "funnel_dropoff", "funnel_device", "funnel_day", "funnel_hour", "funnel_source", "funnel_sankey", "open_funnel"):
    QUERIES[_name] = (lambda operator: lambda spark, sf_dir: operator(sess(spark, sf_dir)))(getattr(funnel, _name))


@register
def kpi_summary(spark, sf_dir):
    return funnel.kpi_summary(funnel.funnel_overall(sess(spark, sf_dir)))


@register
def open_funnel_sketch(spark, sf_dir):
    """A22 from daily sketches beside the exact counts."""
    made = sketches.open_funnel_errors(funnel.open_funnel(sess(spark, sf_dir)), session_days(spark, sf_dir))
    return made.select("step_order", "step_name", "n_days", "user_count", (F.col("relative_error") <= F.col("error_bound")).alias("within_bound"))


# ------------------------------------------------------------------ segments and statistics
@register
def session_browsing_style(spark, sf_dir):
    return segments.browsing_style(sess(spark, sf_dir))


for _name in ("browsing_style_summary", "deep_specialists", "variety_seekers"):
    QUERIES[_name] = (lambda operator: lambda spark, sf_dir: operator(styles(spark, sf_dir)))(getattr(segments, _name))


@register
def style_quantiles_sketch(spark, sf_dir):
    """A12's quantiles from daily sketches, with their exact ranks."""
    made = sketches.style_quantile_errors(styles(spark, sf_dir), style_days(spark, sf_dir))
    return made.select("browsing_style", "percent", "sessions", (F.col("rank_error") <= F.col("rank_bound")).alias("within_bound"))


@register
def segment_coverage(spark, sf_dir):
    return segments.segment_coverage(sess(spark, sf_dir))


@register
def segment_lookup(spark, sf_dir):
    return segments.segment_lookup(segments.deep_specialists(styles(spark, sf_dir)), "depth_segment", "12-24")


@register
def mart_csv_roundtrip(spark, sf_dir):
    """The style mart written as header CSV to the shared folder and loaded with its declared schema."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clickmart-mart-{uuid.uuid4().hex}"
    io.write_mart(segments.browsing_style_summary(styles(spark, sf_dir)), path, fmt="csv")
    return io.load_marts(spark, {"browsing_style": path})["browsing_style"]


def _labelled(kind: str, spark, sf_dir) -> DataFrame:
    """Styled sessions with the ``segment`` label of one of the three segmentations."""
    rows, style, items = styles(spark, sf_dir), F.col("browsing_style"), F.col("total_items_viewed")
    if kind == "style":
        return rows.withColumn("segment", style)
    if kind == "depth":
        return rows.filter(style == segments.DEEP).withColumn("segment", segments.depth_bucket(items))
    return rows.filter(style == segments.VARIETY).withColumn("segment", segments.intensity_bucket(items))


def _counts(kind: str, spark, sf_dir) -> DataFrame:
    return significance.segment_counts(_labelled(kind, spark, sf_dir), "segment")


def _mart_counts(spark, sf_dir) -> DataFrame:
    """Counts rebuilt from the style mart's rounded rates, as the dashboard does (Q11)."""
    return significance.mart_counts(segments.browsing_style_summary(styles(spark, sf_dir)), "browsing_style")


def _shown(compared: DataFrame) -> DataFrame:
    return compared.withColumn("p_value", F.round("p_value", ST.P_DIGITS))


@register
def segment_ci_table(spark, sf_dir):
    return significance.segment_ci_table(_counts("style", spark, sf_dir))


@register
def segment_ci_depth(spark, sf_dir):
    return significance.segment_ci_table(_counts("depth", spark, sf_dir))


@register
def segment_ci_intensity(spark, sf_dir):
    return significance.segment_ci_table(_counts("intensity", spark, sf_dir))


@register
def segment_ci_from_mart(spark, sf_dir):
    return significance.segment_ci_table(_mart_counts(spark, sf_dir))


@register
def segment_compare(spark, sf_dir):
    return _shown(significance.segment_compare(_counts("style", spark, sf_dir), "Variety", "Deep"))


@register
def segment_compare_intensity(spark, sf_dir):
    return _shown(significance.segment_compare(
        _counts("intensity", spark, sf_dir), "Super Heavy|85", "Light|24개 이하", regex=True,
        bands=ST.EFFECT_BANDS_INTENSITY, default_label=ST.EFFECT_DEFAULT_INTENSITY))


@register
def segment_compare_from_mart(spark, sf_dir):
    return _shown(significance.segment_compare(_mart_counts(spark, sf_dir), "Variety", "Deep"))


@register
def chi_square_2x2(spark, sf_dir):
    compared = significance.segment_compare(_counts("style", spark, sf_dir), "Variety", "Deep")
    return compared.select("segment_a", "segment_b", "chi2", F.lit(1).alias("dof"))


@register
def chi_square_kx2_depth(spark, sf_dir):
    return significance.chi_square_segments(_counts("depth", spark, sf_dir))


@register
def chi_square_kx2_intensity(spark, sf_dir):
    return significance.chi_square_segments(_counts("intensity", spark, sf_dir))


@register
def chi_square_pvalues(spark, sf_dir):
    """The three tests of the segment pages with their tail probabilities, from one pass over the styles."""
    style, items = F.col("browsing_style"), F.col("total_items_viewed")
    tests = F.array(
        F.struct(F.lit("style 2x2").alias("test"), F.when(style.isin(segments.VARIETY, segments.DEEP), style).alias("segment")),
        F.struct(F.lit("depth kx2").alias("test"), F.when(style == segments.DEEP, segments.depth_bucket(items)).alias("segment")),
        F.struct(F.lit("intensity kx2").alias("test"), F.when(style == segments.VARIETY, segments.intensity_bucket(items)).alias("segment")))
    tagged = (styles(spark, sf_dir).select("session_unique_id", "is_converted", F.explode(tests).alias("t"))
              .select("session_unique_id", "is_converted", "t.*").filter(F.col("segment").isNotNull()))
    counts = tagged.groupBy("test", "segment").agg(F.count("session_unique_id").alias("sessions"),
                                                   F.sum("is_converted").cast("bigint").alias("conversions"))
    return significance.with_p_value(significance.chi_square_segments(counts, by=("test",)), "chi2", "dof", ST.P_DIGITS)


# ------------------------------------------------------------------ scoring
@register
def engage_lift_score(spark, sf_dir):
    return scoring.engage_lift_score(feats(spark, sf_dir))


for _name in ("lift_weight", "lift_long", "score_short"):
    QUERIES[_name] = (lambda operator: lambda spark, sf_dir: operator(sess(spark, sf_dir)))(getattr(scoring, _name))


@register
def core_sessions(spark, sf_dir):
    return scoring.core_sessions(feats(spark, sf_dir), paths_table(spark, sf_dir), scores=graded(spark, sf_dir))


# ------------------------------------------------------------------ carts
@register
def cart_abandon(spark, sf_dir):
    return cart.cart_abandon(stg(spark, sf_dir), cart.abandoned_sessions(feats(spark, sf_dir), scores=graded(spark, sf_dir)))


@register
def exclude_items(spark, sf_dir):
    return cart_clean(spark, sf_dir)


@register
def main_category(spark, sf_dir):
    return cart_clean(spark, sf_dir).select("item_name", "item_category", cart.main_category(F.col("item_category")).alias("main_category"))


for _name in ("category_loss_rollup", "category_filter_loss", "cart_totals", "category_top_n"):
    QUERIES[_name] = (lambda operator: lambda spark, sf_dir: operator(cart_clean(spark, sf_dir)))(getattr(cart, _name))


@register
def loss_count_correlation(spark, sf_dir):
    return cart.loss_count_correlation(cart_clean(spark, sf_dir)).select(F.round("pearson_r", 10).alias("pearson_r"))


for _by, _name in (("total_lost_revenue", "cart_top_n_value"), ("abandoned_session_count", "cart_top_n_sessions"),
                   ("avg_lost_value", "cart_top_n_average")):
    QUERIES[_name] = (lambda by: lambda spark, sf_dir: cart.cart_top_n(cart_clean(spark, sf_dir), by, 10))(_by)


# ------------------------------------------------------------------ promotions
@register
def promo_performance(spark, sf_dir):
    return promo.promo_performance(stg(spark, sf_dir))


@register
def promo_quality(spark, sf_dir):
    rows = stg(spark, sf_dir)
    return promo.promo_quality(rows, feats(spark, sf_dir), promo.promo_performance(rows), scores=graded(spark, sf_dir))


@register
def promo_summary(spark, sf_dir):
    return promo.promo_summary(quality_mart(spark, sf_dir))


@register
def hidden_gems(spark, sf_dir):
    return promo.hidden_gems(quality_mart(spark, sf_dir))


# ------------------------------------------------------------------ friction, time to purchase
@register
def device_friction(spark, sf_dir):
    return friction.device_friction(stg(spark, sf_dir), feats(spark, sf_dir), scores=graded(spark, sf_dir))


@register
def device_friction_by_session(spark, sf_dir):
    return friction.device_friction(stg(spark, sf_dir), feats(spark, sf_dir), grain="session", scores=graded(spark, sf_dir))


@register
def time_to_conversion(spark, sf_dir):
    return friction.time_to_conversion(sess(spark, sf_dir))


# ------------------------------------------------------------------ baskets
@register
def price_tier(spark, sf_dir):
    return basket.price_tier(stg(spark, sf_dir))


@register
def price_tier_alt(spark, sf_dir):
    return basket.price_tier(stg(spark, sf_dir), alt_order=True)


@register
def price_cutoffs_sketch(spark, sf_dir):
    """A07's cut-offs from daily sketches, with their exact ranks."""
    made = sketches.price_cutoff_errors(stg(spark, sf_dir), price_days(spark, sf_dir))
    return made.select("quantile", "n_days", "n_views", (F.col("rank_error") <= F.col("rank_bound")).alias("within_bound"))


@register
def item_prices_from_days(spark, sf_dir):
    """A07's item averages from the daily states."""
    return sketches.price_tier_from_state(item_days(spark, sf_dir), price_days(spark, sf_dir)).select("item_name", "avg_price")


@register
def product_association(spark, sf_dir):
    return basket.product_association(stg(spark, sf_dir))


def _bundle(spark, sf_dir, mid_name: str) -> DataFrame:
    return basket.bundle_strategy(stg(spark, sf_dir), feats(spark, sf_dir), tiers=tiers_table(spark, sf_dir),
                                  mid_name=mid_name, scores=graded(spark, sf_dir))


@register
def bundle_strategy(spark, sf_dir):
    return _bundle(spark, sf_dir, basket.REFERENCE_MID_NAME)


@register
def bundle_strategy_fixed(spark, sf_dir):
    return _bundle(spark, sf_dir, basket.MID)


@register
def market_basket_orders(spark, sf_dir):
    return basket.order_pair_sales(**read_tables(spark, sf_dir, ("lineitem", "part")))
