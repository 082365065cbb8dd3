"""Promotions: A09 promo_performance, A24 promo_quality, A46 promo_summary,
A47 hidden_gems.

A24 joins click rows to session facts only to count and weight them (survey
P4): clicks are pre-aggregated to (promotion, session, rows) before the join,
so the join input is at most one row per clicked session and promotion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, pct
from clickmart.operators.scoring import graded_sessions
from clickmart.operators.sessions import SESSION
from clickmart.operators.staging import NOT_SET

# Quadrant labels and thresholds of the promotion mart.
STAR = "Star (확대)"
CLICKBAIT = "Clickbait (낚시성)"
HIDDEN_GEM = "Hidden Gem (숨은 보석)"
POOR = "Poor (제거 대상)"
CTR_CUT = 5.0
SCORE_CUT = 50
MIN_IMPRESSIONS = 50


def promo_performance(stg: DataFrame, min_impressions: int = MIN_IMPRESSIONS) -> DataFrame:
    """Impressions, clicks and CTR % per promotion with more than ``min_impressions``."""
    agg = (stg.filter(F.col("promotion_name") != NOT_SET)
           .groupBy("promotion_name")
           .agg(F.count_if(F.col("event_name") == "view_promotion").alias("impressions"),
                F.count_if(F.col("event_name") == "select_promotion").alias("clicks")))
    return agg.filter(F.col("impressions") > min_impressions).select(
        "promotion_name", "impressions", "clicks",
        F.round(pct(F.col("clicks"), F.col("impressions")), 2).alias("ctr_percent"))


def promo_quality(stg: DataFrame, features: DataFrame, performance: DataFrame,
                  ctr_cut: float = CTR_CUT, score_cut: float = SCORE_CUT,
                  scores: DataFrame | None = None) -> DataFrame:
    """Per clicked promotion: CTR, click sessions, row-weighted average score,
    High-Intent click rows, CVR % (converting click rows / click sessions, Q7), quadrant."""
    clicks = (stg.filter((F.col("event_name") == "select_promotion") & (F.col("promotion_name") != NOT_SET))
              .groupBy("promotion_name", SESSION).agg(F.count(F.lit(1)).alias("n")))
    joined = clicks.join(graded_sessions(features, scores), SESSION, "left")
    n = F.col("n")
    click_sessions = F.count(SESSION)
    q = joined.groupBy("promotion_name").agg(
        click_sessions.alias("click_sessions"),
        F.round(F.try_divide(F.sum(n * F.col("engagement_score")).cast("double"),
                             F.sum(F.when(F.col("engagement_score").isNotNull(), n)).cast("double")), 1)
        .alias("avg_session_score"),
        F.coalesce(F.sum(F.when(F.col("engagement_grade") == "High Intent", n)), F.lit(0)).cast("bigint")
        .alias("high_intent_session_count"),
        F.round(pct(F.coalesce(F.sum(F.when(F.col("has_purchase") == 1, n)), F.lit(0)), click_sessions), 2)
        .alias("promo_cvr"),
    )
    perf = performance.select("promotion_name", "ctr_percent")
    out = q.join(perf, "promotion_name", "left")
    ctr, score = F.col("ctr_percent"), F.col("avg_session_score")
    status = fold_cases([
        ((ctr >= ctr_cut) & (score >= score_cut), STAR),
        ((ctr >= ctr_cut) & (score < score_cut), CLICKBAIT),
        ((ctr < ctr_cut) & (score >= score_cut), HIDDEN_GEM),
    ], POOR)
    return out.select("promotion_name", "ctr_percent", "click_sessions", "avg_session_score",
                      "high_intent_session_count", "promo_cvr", status.alias("promo_status"))


def promo_summary(quality: DataFrame) -> DataFrame:
    """The summary projection and the chart label ``name<br>CVR: x.x%``."""
    return quality.select(
        "promotion_name", "ctr_percent", "promo_cvr", "click_sessions", "promo_status",
        F.format_string("%s<br>CVR: %.1f%%", F.col("promotion_name"), F.col("promo_cvr")).alias("label"))


def hidden_gems(quality: DataFrame, status: str = "Hidden Gem") -> DataFrame:
    """The first promotion (mart order: click sessions desc) whose status contains ``status``."""
    return (quality.filter(F.coalesce(F.col("promo_status").contains(status), F.lit(False)))
            .orderBy(F.desc("click_sessions"), "promotion_name").limit(1)
            .select("promotion_name", "ctr_percent", "avg_session_score", "promo_cvr"))
