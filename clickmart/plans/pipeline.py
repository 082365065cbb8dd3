"""The whole model DAG in one session: ``build_all`` and ``write_all``.

Order follows the reference's model dependencies (staging -> intermediate ->
marts).  The shared models — staged rows, fused session aggregate, scores —
are materialised once and every mart reads them:

* ``materialize="table"`` (default) writes them as parquet under
  ``spark.checkpoint.dir`` (the cluster's shared folder) and reads them back:
  lineage is cut, a lost executor costs a file re-read, and later scans prune
  columns and ``event_date`` partitions.
* ``"checkpoint"`` uses ``DataFrame.checkpoint()`` into the same folder.
* ``"persist"`` keeps them in executor memory/disk (recomputed on loss).
* ``"none"`` leaves every mart a standalone plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.conf import ensure_checkpoint_dir
from clickmart.functions import stats
from clickmart.operators import basket, cart, friction, funnel, promo, scoring, segments, sessions, significance, sketches
from clickmart.operators.staging import stage_events
from clickmart.plans.incremental import facts_in_halves
from clickmart.sources import io


def _materialize(df: DataFrame, mode: str, name: str, run_id: str, partition_by=()) -> DataFrame:
    if mode == "none":
        return df
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    if mode == "checkpoint":
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/clickmart-run-{run_id}/{name}"
    out = df
    if partition_by:  # staged rows: by date, and by event name within a file
        out = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, "event_name")
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def build_all(events: DataFrame, start_date: str | None = None, end_date: str | None = None,
              materialize: str = "table", has_event_id: bool = True) -> dict[str, DataFrame]:
    """Nested events -> every model of the DAG, keyed by model name."""
    run_id = uuid.uuid4().hex[:12]
    stg = _materialize(stage_events(events, start_date, end_date, has_event_id=has_event_id), materialize, "stg_events", run_id,
                       partition_by=["event_date"] if materialize == "table" else ())
    feats = _materialize(sessions.session_features(stg), materialize, "session_features", run_id)
    def keep(df: DataFrame, name: str) -> DataFrame:
        return _materialize(df, materialize, name, run_id)

    sess = keep(sessions.session_level(feats), "session_level")
    graded = keep(scoring.engage_lift_score(feats, keep=["has_purchase"]), "engage_lift_score")
    scores = graded
    paths = keep(sessions.session_paths(stg), "session_paths")
    styles = keep(segments.browsing_style(sess), "session_browsing_style")
    perf = keep(promo.promo_performance(stg), "promo_performance")
    carts = keep(cart.cart_abandon(stg, cart.abandoned_sessions(feats, scores=scores)), "cart_abandon")
    clean = cart.exclude_items(carts)
    quality = keep(promo.promo_quality(stg, feats, perf, scores=scores), "promo_quality")
    tiers = keep(basket.price_tier(stg), "price_tier")
    style_counts = significance.segment_counts(styles.withColumnRenamed("browsing_style", "segment"), "segment")
    depth_counts = significance.segment_counts(
        styles.filter(F.col("browsing_style") == segments.DEEP)
        .withColumn("segment", segments.depth_bucket(F.col("total_items_viewed"))), "segment")
    intensity_counts = significance.segment_counts(
        styles.filter(F.col("browsing_style") == segments.VARIETY)
        .withColumn("segment", segments.intensity_bucket(F.col("total_items_viewed"))), "segment")
    deep = segments.deep_specialists(styles)
    price_days = keep(sketches.daily_price_sketches(stg), "price_sketches")
    open_funnel, facts = funnel.open_funnel(sess), f"{ensure_checkpoint_dir(events.sparkSession).rstrip('/')}/clickmart-facts-{run_id}"

    out: dict[str, DataFrame] = {
        "stage_events": stg,
        "session_funnel": sessions.session_funnel(sessions=sess),
        "session_paths": paths,
        "session_browsing_style": styles,
        "lift_weight": scoring.lift_weight(sess),
        "engage_lift_score": graded.drop("has_purchase"),
        "price_tier": tiers,
        "product_association": basket.product_association(stg),
        "promo_performance": perf,
        "core_sessions": scoring.core_sessions(feats, paths, scores=graded),
        "cart_abandon": carts,
        "browsing_style_summary": segments.browsing_style_summary(styles),
        "deep_specialists": deep,
        "variety_seekers": segments.variety_seekers(styles),
        "funnel_overall": funnel.funnel_overall(sess),
        "funnel_dropoff": funnel.funnel_dropoff(sess),
        "funnel_device": funnel.funnel_device(sess),
        "funnel_day": funnel.funnel_day(sess),
        "funnel_hour": funnel.funnel_hour(sess),
        "funnel_source": funnel.funnel_source(sess),
        "funnel_sankey": funnel.funnel_sankey(sess),
        "open_funnel": open_funnel,
        "device_friction": friction.device_friction(stg, feats, scores=scores),
        "promo_quality": quality,
        "bundle_strategy": basket.bundle_strategy(stg, feats, tiers=tiers, scores=scores),
        "time_to_conversion": friction.time_to_conversion(sess),
        # dashboard statistics and rollups
        "segment_ci_table": significance.segment_ci_table(style_counts),
        "segment_compare": significance.segment_compare(style_counts, "Variety", "Deep"),
        "kpi_summary": funnel.kpi_summary(funnel.funnel_overall(sess)),
        "segment_coverage": segments.segment_coverage(sess),
        "category_loss_rollup": cart.category_loss_rollup(clean),
        "category_filter_loss": cart.category_filter_loss(clean),
        "cart_totals": cart.cart_totals(clean),
        "category_top_n": cart.category_top_n(clean),
        "promo_summary": promo.promo_summary(quality),
        "lift_long": scoring.lift_long(sess),
        "score_short": scoring.score_short(sess),
        "price_tier_alt": basket.price_tier(stg, alt_order=True),
        "device_friction_by_session": friction.device_friction(stg, feats, grain="session", scores=scores),
        "bundle_strategy_fixed": basket.bundle_strategy(stg, feats, tiers=tiers, scores=scores, mid_name=basket.MID),
        "segment_ci_depth": significance.segment_ci_table(depth_counts),
        "segment_ci_intensity": significance.segment_ci_table(intensity_counts),
        "segment_compare_intensity": significance.segment_compare(
            intensity_counts, "Super Heavy|85", "Light|24개 이하", regex=True,
            bands=stats.EFFECT_BANDS_INTENSITY, default_label=stats.EFFECT_DEFAULT_INTENSITY),
        "chi_square_kx2_depth": significance.chi_square_segments(depth_counts),
        "chi_square_kx2_intensity": significance.chi_square_segments(intensity_counts),
        "segment_lookup": segments.segment_lookup(deep, "depth_segment", "12-24"),
        "exclude_items": clean,
        "main_category": clean.select("item_name", "item_category", cart.main_category(F.col("item_category")).alias("main_category")),
        "loss_count_correlation": cart.loss_count_correlation(clean).select(F.round("pearson_r", 10).alias("pearson_r")),
        "cart_top_n_value": cart.cart_top_n(clean, "total_lost_revenue"),
        "cart_top_n_sessions": cart.cart_top_n(clean, "abandoned_session_count"),
        "cart_top_n_average": cart.cart_top_n(clean, "avg_lost_value"),
        "hidden_gems": promo.hidden_gems(quality),
        # daily states and pieces
        "session_path_pieces": sessions.session_path_pieces(stg),
        "session_facts_incremental": facts_in_halves(stg, facts),
        "open_funnel_sketch": sketches.open_funnel_errors(open_funnel, keep(sketches.daily_session_sketches(stg), "session_sketches"))
        .select("step_order", "step_name", "n_days", "user_count", (F.col("relative_error") <= F.col("error_bound")).alias("within_bound")),
        "style_quantiles_sketch": sketches.style_quantile_errors(styles, keep(sketches.daily_style_sketches(styles, sess), "style_sketches"))
        .select("browsing_style", "percent", "sessions", (F.col("rank_error") <= F.col("rank_bound")).alias("within_bound")),
        "price_cutoffs_sketch": sketches.price_cutoff_errors(stg, price_days)
        .select("quantile", "n_days", "n_views", (F.col("rank_error") <= F.col("rank_bound")).alias("within_bound")),
        "item_prices_from_days": sketches.price_tier_from_state(keep(sketches.daily_item_prices(stg), "item_prices"), price_days)
        .select("item_name", "avg_price"),
    }
    return out


def write_all(models: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Full-refresh sink of every model; staging keeps its date partitions."""
    paths = {}
    for name, df in models.items():
        path = f"{base.rstrip('/')}/{name}"
        if name == "stage_events":
            io.write_staged(df, path)
        else:
            io.write_mart(df, path, fmt)
        paths[name] = path
    return paths
