"""Scoring: A05 lift_weight, A06 engage_lift_score, A10 core_sessions,
A49 lift_long, A50 score_short, and the global percent rank (survey P3).

The reference ranks all sessions with ``PERCENT_RANK() OVER (ORDER BY score
DESC)``, a window without partition that would pull every session into one
task.  ``percent_rank_desc`` computes the same doubles from the score
histogram: rank - 1 of a session = number of sessions with a higher score.
The histogram has one row per distinct score; since d distinct positive
integer scores need a score total of at least d(d+1)/2, d <= sqrt(2·Σscore),
so the single-task cumulative sum runs over a few million rows even at 10^12
events.  The grade falls with the rank, so A06 takes from the histogram only
the lowest score of each grade: no session is joined or shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.rules import fold_cases, safe_div
from clickmart.operators.sessions import SESSION, session_paths

# Grade bands of the percent rank.
GRADES = [(0.2, "High Intent"), (0.5, "Medium Intent")]
LOW_GRADE = "Low Intent"
CORE_GRADES = ["High Intent", "Medium Intent"]
# Actions whose lift A05 reports, as (output column, session flag).
LIFT_ACTIONS = [
    ("score_view", "has_view_item"),
    ("score_search", "has_search"),
    ("score_cart", "has_add_to_cart"),
    ("score_checkout", "has_begin_checkout"),
    ("score_payment", "has_add_payment_info"),
]
# Actions of the long-form lift (event name, session flag).
LIFT_LONG_ACTIONS = [
    ("view_item", "has_view_item"),
    ("add_to_cart", "has_add_to_cart"),
    ("begin_checkout", "has_begin_checkout"),
    ("add_payment_info", "has_add_payment_info"),
]


def percent_rank_desc(df: DataFrame, score_col: str, out_col: str = "pct_rank") -> DataFrame:
    """``df`` plus ``PERCENT_RANK() OVER (ORDER BY score_col DESC)``, without a global window on ``df``.

    The histogram is joined back on the score; AQE splits a score that many rows share."""
    return df.join(rank_histogram(df, score_col, out_col), on=score_col, how="inner")


def rank_histogram(df: DataFrame, score_col: str, out_col: str = "pct_rank") -> DataFrame:
    """One row for each distinct score with its descending percent rank."""
    hist = df.groupBy(score_col).agg(F.count(F.lit(1)).alias("_n_at"))
    above = Window.orderBy(F.desc(score_col)).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    return hist.select(
        score_col,
        F.coalesce(F.sum("_n_at").over(above), F.lit(0)).alias("_n_above"),
        F.sum("_n_at").over(everything).alias("_n_total"),
    ).select(
        score_col,
        F.when(F.col("_n_total") <= 1, F.lit(0.0))
        .otherwise(F.col("_n_above").cast("double") / (F.col("_n_total") - 1).cast("double")).alias(out_col),
    )


def engage_lift_score(features: DataFrame, grades=GRADES, low: str = LOW_GRADE,
                      score_col: str = "engagement_score", keep=()) -> DataFrame:
    """Score per (session, user) and the grade of its global percent rank (desc).

    One scalar subquery gives the lowest score that reaches each grade.

    ``keep`` carries further feature columns (e.g. ``has_purchase``) through
    the ranking, so marts that need the grade and a session fact do not join
    the features again."""
    score, rank = F.col(score_col), F.col("pct_rank")
    reached = rank_histogram(features.select(score_col), score_col).agg(
        *[F.min(F.when(rank <= t, score)).alias(f"cut{i}") for i, (t, _) in enumerate(grades)])
    cuts = reached.select(F.struct("*").alias("cuts")).scalar()
    graded = features.select(SESSION, "user_pseudo_id", score.alias("engagement_score"), cuts.alias("_cuts"), *keep)
    score = F.col("engagement_score")
    grade = fold_cases([(score >= F.col("_cuts")[f"cut{i}"], g) for i, (_, g) in enumerate(grades)], low)
    return graded.select(SESSION, "user_pseudo_id", "engagement_score", grade.alias("engagement_grade"), *keep)


def graded_sessions(features: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Non-NULL sessions with score, grade and conversion flag (the facts the
    marts join event rows to).  Uses ``scores`` when it already carries
    ``has_purchase``; otherwise ranks ``features`` carrying it along."""
    if scores is None or "has_purchase" not in scores.columns:
        if scores is not None:
            conv = features.filter(F.col(SESSION).isNotNull()).select(SESSION, "has_purchase")
            scores = scores.join(conv, SESSION, "left")
        else:
            scores = engage_lift_score(features, keep=["has_purchase"])
    return scores.filter(F.col(SESSION).isNotNull()).select(
        SESSION, "engagement_score", "engagement_grade", "has_purchase")


def lift_weight(sessions: DataFrame, digits: int = 1) -> DataFrame:
    """Lift of each action = P(purchase | action) / P(purchase), rounded."""
    conv = F.col("has_purchase") == 1
    base = safe_div(F.sum("has_purchase"), F.count(F.lit(1)))
    cols = []
    for out, flag_col in LIFT_ACTIONS:
        did = F.col(flag_col) == 1
        cond_rate = safe_div(F.count_if(did & conv), F.count_if(did))
        cols.append(F.round(F.try_divide(cond_rate, base), digits).alias(out))
    return sessions.agg(*cols)


def lift_long(sessions: DataFrame) -> DataFrame:
    """One row per action with conditional purchase rate, lift and rounded weight.

    Distinct-session counts come from the session flags (NULL session excluded,
    as COUNT(DISTINCT) does); actions nobody performed give no row."""
    keyed = sessions.filter(F.col(SESSION).isNotNull())
    conv = F.col("has_purchase") == 1
    aggs = [F.count(F.lit(1)).alias("_n"), F.count_if(conv).alias("_conv")]
    for name, flag_col in LIFT_LONG_ACTIONS:
        did = F.col(flag_col) == 1
        aggs += [F.count_if(did).alias(f"_{name}_n"), F.count_if(did & conv).alias(f"_{name}_c")]
    counts = keyed.agg(*aggs)
    base = safe_div(F.col("_conv"), F.col("_n"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("event_name"),
                 F.col(f"_{name}_n").alias("_sessions"),
                 safe_div(F.col(f"_{name}_c"), F.col(f"_{name}_n")).alias("conditional_purchase_rate"))
        for name, _ in LIFT_LONG_ACTIONS]))
    out = counts.select(base.alias("_base"), rows.alias("r")).select("_base", "r.*")
    out = out.filter(F.col("_sessions") > 0)
    lift = F.try_divide(F.col("conditional_purchase_rate"), F.col("_base"))
    return out.select("event_name", "conditional_purchase_rate", lift.alias("lift"),
                      F.round(lift, 0).alias("score_weight"))


def score_short(sessions: DataFrame) -> DataFrame:
    """Per session score with the short weight map (no search weight)."""
    return sessions.select(SESSION, F.col("engagement_score_short").alias("engagement_score"))


def core_sessions(features: DataFrame, paths: DataFrame | None = None, grades=GRADES, low: str = LOW_GRADE,
                  keep_grades=CORE_GRADES, scores: DataFrame | None = None, stg: DataFrame | None = None) -> DataFrame:
    """A10: High/Medium sessions with path, conversion (default 0) and missed-opportunity flag.

    From ``stg`` only the core sessions' rows are kept (a semi-join) before
    their paths are built; the NULL session, which never matches, is not built
    at all.  ``paths`` is ``session_paths(stg)`` where it exists already.
    ``scores`` (A06 output) is used when given instead of ranking ``features``."""
    if scores is None:
        scores = engage_lift_score(features, grades, low)
    graded = scores.select(SESSION, "user_pseudo_id", "engagement_score", "engagement_grade") \
        .filter(F.col("engagement_grade").isin(*keep_grades))
    if paths is None:
        keyed = graded.filter(F.col(SESSION).isNotNull()).select(SESSION)
        paths = session_paths(stg.join(keyed, SESSION, "left_semi"))
    joined = graded.join(paths, graded[SESSION] == paths[SESSION], "left").drop(paths[SESSION])
    converted = F.coalesce(F.col("is_converted"), F.lit(0))
    return joined.select(SESSION, "user_pseudo_id", "engagement_grade", "engagement_score", "full_path",
                         "path_length", converted.alias("is_converted"),
                         (converted == 0).alias("is_missed_opportunity"))
