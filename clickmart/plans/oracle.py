"""DuckDB SQL of every registered query, as an independent check of the Spark plans.

Each statement starts from the driver's raw tables, derives the staged rows by
the integer rules of FIXTURES.md section 2.2 and states the mart's rule in its
own way: ranks by counting, percentiles by cumulative shares, pairs from item
lists, facts of a session gathered once.  Labels, thresholds and weights come
from the operators' constants.  Ratios are DOUBLE; ROUND goes through DECIMAL
(half away from zero, as Spark rounds).
"""

from __future__ import annotations

from clickmart.functions import stats as ST
from clickmart.operators import basket, cart, friction, funnel, promo, scoring, segments, sessions
from clickmart.operators.staging import ACTION_TYPES, DEFAULT_ACTION, NOT_SET
from clickmart.sources import binding as B

Z95 = ST.z_value(0.95)


def text(value: str) -> str:
    """A SQL string literal."""
    quoted = value.replace("'", "''")
    return f"'{quoted}'"


def names(values) -> str:
    return ", ".join(text(v) for v in values)


def values(table: str, columns: str, rows) -> str:
    """A CTE of literal rows."""
    body = ", ".join("(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"{table}({columns}) AS (VALUES {body})"


def dbl(x: float) -> str:
    """A DOUBLE literal with the exact value of the Python float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def rpct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"{ratio(num, den)} * 100.0", digits)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts if p) + "\n"


# ------------------------------------------------------------------ staged rows
STG_CTE = f"""
{values("actions", "event_name, action_type", ACTION_TYPES)},
clicks AS (
  SELECT *, user_id % 10 = {B.HEAVY_USER} AS heavy, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS t
  FROM events
),
spans AS (
  SELECT *, CASE WHEN heavy THEN {B.HUNDRED_DAYS_US} WHEN user_id % 2 = 0 THEN {B.TEN_DAYS_US} ELSE {B.TWO_DAYS_US} END AS span FROM clicks
),
timed AS (
  SELECT *, t // span AS visit, span * (t // span) + {B.HOUR_US} * (user_id % 24) + (t % span) // (span // {B.VISIT_US}) AS moment FROM spans
),
happened AS (
  SELECT *, CASE
      WHEN event_type = 'view' THEN if(k % 5 = 0, 'view_promotion', 'view_item')
      WHEN event_type = 'click' AND k % 5 <> 0 THEN 'add_to_cart'
      WHEN event_type = 'click' THEN if(k < 75 OR event_id % {B.RARE_CLICK} = 0, 'select_promotion', 'page_view')
      WHEN event_type = 'signup' THEN if(k < 50, 'session_start', 'view_search_results')
      WHEN event_type = 'purchase' AND k < 12 THEN 'purchase'
      WHEN event_type = 'purchase' THEN if(k < 60, 'begin_checkout', 'add_payment_info')
      WHEN event_type = 'error' THEN if(heavy, 'view_item', 'page_view') END AS event_name,
    if(event_id % {B.NO_SESSION_EVERY} = {B.NO_SESSION_REST}, NULL, CAST(visit AS BIGINT)) AS visit_id,
    if(user_id % 5 = 0, 'M' || CAST(user_id AS VARCHAR), NULL) AS member
  FROM timed
),
bought AS (
  SELECT l_orderkey AS event_id, p_partkey, p_name, CAST(l_quantity AS BIGINT) AS quantity, p_type, p_brand,
    CAST(3 + (ascii(p_name) * 7 + length(p_name) * 13) % 97 AS DOUBLE) AS price
  FROM lineitem, part WHERE l_partkey = p_partkey
),
stg AS (
  SELECT strftime(make_timestamp(h.moment), '%Y%m%d') AS event_date, make_timestamp(h.moment) AS event_timestamp,
    CAST(user_id AS VARCHAR) AS user_pseudo_id, member AS member_id, COALESCE(member, CAST(user_id AS VARCHAR)) AS master_id,
    CAST(member IS NOT NULL AS INTEGER) AS is_member,
    CASE user_id % 4 WHEN 0 THEN NULL WHEN 2 THEN 'partner' ELSE 'google' END AS session_source,
    CASE user_id % 4 WHEN 1 THEN 'organic' WHEN 2 THEN 'referral' WHEN 3 THEN 'cpc' END AS session_medium,
    if(user_id % 4 = 3, 'c' || CAST(k // 10 AS VARCHAR), NULL) AS session_campaign,
    CAST(user_id AS VARCHAR) || '-' || CAST(visit_id AS VARCHAR) AS session_unique_id, visit_id AS session_id,
    CAST(if(h.event_id % 3 = 0, 0, k % 2) AS BIGINT) AS is_engaged, CAST(if(k < 10, 0, k * 100) AS BIGINT) AS engagement_time_msec,
    'Page ' || CAST(k % 10 AS VARCHAR) AS page_title, {text(B.PAGE_URL_PREFIX)} || CAST(k AS VARCHAR) AS page_url,
    if(event_name IN ({names(B.PROMO_EVENTS)}), 'Promo ' || chr(CAST(65 + k // 25 AS INTEGER)), {text(NOT_SET)}) AS promotion_name,
    COALESCE(action_type, {text(DEFAULT_ACTION)}) AS action_type, event_name,
    if(event_name = 'purchase', 'T' || CAST(h.event_id AS VARCHAR), NULL) AS transaction_id,
    if(event_name = 'purchase', CAST(floor(value) AS DOUBLE), NULL) AS purchase_revenue,
    CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name,
    CASE WHEN p_name IS NULL THEN NULL WHEN user_id % 3 = 0 THEN 'Home/Apparel/' WHEN p_type = 'PROMO' THEN NULL
         WHEN p_type = 'LARGE' THEN 'Home/Bags/' WHEN p_type = 'SMALL' THEN 'Home/Shop by Brand/' || p_brand || '/'
         ELSE 'Home/Apparel/' END AS item_category,
    price AS item_price, quantity AS item_quantity, COALESCE(price * quantity, 0) AS item_revenue_calc,
    CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
    'C' || CAST(user_id % 25 AS VARCHAR) AS country, h.event_id
  FROM happened h LEFT JOIN actions USING (event_name)
  LEFT JOIN bought b ON b.event_id = h.event_id AND h.event_name IN ({names(B.ITEM_EVENTS)})
)"""

# ------------------------------------------------------------------ facts of a session
_FLAGS = ", ".join(f"CAST(bool_or(event_name = {text(e)}) AS INTEGER) AS {c}"
                   for c, e in [*sessions.FUNNEL_FLAGS, ("has_search", "view_search_results")])
SESSION_CTE = f"""
sess AS (
  SELECT session_unique_id, MAX(session_source) AS session_source, MAX(session_medium) AS session_medium,
    MAX(session_campaign) AS session_campaign, MAX(device_category) AS device_category, MAX(is_member) AS is_member,
    MIN(event_timestamp) AS session_start_at, CAST(MIN(hour(event_timestamp)) AS INTEGER) AS session_hour,
    CAST(MIN(isodow(event_timestamp) % 7 + 1) AS INTEGER) AS session_day_of_week, {_FLAGS}, MAX(purchase_revenue) AS revenue
  FROM stg GROUP BY ALL
)"""
_POINTS = list(sessions.SCORE_WEIGHTS.items())
_BANDS = " ".join(f"WHEN beaten_by <= {t} THEN {text(g)}" for t, g in scoring.GRADES)
# Percent rank by counting: the share of the other (session, user) rows with more points.
SCORES_CTE = f"""
{values("points", "event_name, points", _POINTS)},
totals AS (
  SELECT session_unique_id, user_pseudo_id, CAST(SUM(COALESCE(points, {sessions.DEFAULT_WEIGHT})) AS BIGINT) AS total
  FROM stg LEFT JOIN points USING (event_name) GROUP BY ALL
),
steps AS (SELECT total, COUNT(*) AS here FROM totals GROUP BY total),
ladder AS (
  SELECT s.total, COALESCE(CAST((SELECT SUM(higher.here) FROM steps higher WHERE higher.total > s.total) AS DOUBLE)
         / NULLIF((SELECT COUNT(*) - 1 FROM totals), 0), 0) AS beaten_by FROM steps s
),
scores AS (
  SELECT session_unique_id, user_pseudo_id, total AS engagement_score, CASE {_BANDS} ELSE {text(scoring.LOW_GRADE)} END AS engagement_grade
  FROM totals JOIN ladder USING (total)
)"""
PATHS_CTE = f"""
walks AS (
  SELECT session_unique_id, array_to_string(list(event_name ORDER BY event_timestamp, event_id), {text(sessions.PATH_SEPARATOR)}) AS full_path,
    CAST(COUNT(*) AS BIGINT) AS path_length, CAST(bool_or(event_name = 'purchase') AS INTEGER) AS is_converted
  FROM stg GROUP BY ALL
)"""
# What the marts know of a keyed session: points, grade, and whether it bought.
FACTS_CTE = """
facts AS (
  SELECT session_unique_id, engagement_score, engagement_grade,
    session_unique_id IN (SELECT session_unique_id FROM stg WHERE event_name = 'purchase' AND session_unique_id IS NOT NULL) AS buyer
  FROM scores WHERE session_unique_id IS NOT NULL
)"""
STYLES_CTE = f"""
looks AS (
  SELECT session_unique_id, CAST(COUNT(DISTINCT item_category) AS BIGINT) AS kinds, CAST(COUNT(item_name) AS BIGINT) AS n
  FROM stg WHERE event_name = 'view_item' GROUP BY ALL
),
buyers AS (SELECT DISTINCT session_unique_id, 1 AS bought FROM stg WHERE event_name = 'purchase'),
styles AS (
  SELECT l.session_unique_id, kinds AS distinct_categories_viewed, n AS total_items_viewed, COALESCE(bought, 0) AS is_converted,
    CASE WHEN n < 3 THEN {text(segments.LIGHT)} WHEN kinds = 0 THEN {text(segments.OTHERS)}
         WHEN kinds = 1 THEN {text(segments.DEEP)} ELSE {text(segments.VARIETY)} END AS browsing_style
  FROM looks l LEFT JOIN buyers b ON l.session_unique_id IS NOT DISTINCT FROM b.session_unique_id WHERE n > 0
)"""
S = STG_CTE
WITH_STG = ctes(S)
WITH_SESSIONS = ctes(S, SESSION_CTE)
ORACLE: dict[str, str] = {}

ORACLE["stage_events"] = WITH_STG + "SELECT * FROM stg"
ORACLE["session_funnel"] = WITH_SESSIONS + "SELECT * EXCLUDE (has_search) FROM sess"
ORACLE["session_paths"] = ctes(S, PATHS_CTE) + "SELECT * FROM walks"

# ------------------------------------------------------------------ funnels
_TOTALS = "tally AS (SELECT " + ", ".join(
    [f"{big('COUNT(*)')} AS total_sessions"] + [f"{big(f'COUNT(*) FILTER (WHERE {c} = 1)')} AS {n}" for n, c in (
        ("viewed", "has_view_item"), ("carted", "has_add_to_cart"), ("checkout", "has_begin_checkout"),
        ("payment", "has_add_payment_info"), ("purchased", "has_purchase"))]) + " FROM sess)"
WITH_TALLY = ctes(S, SESSION_CTE, _TOTALS)
ORACLE["funnel_overall"] = WITH_TALLY + (
    "SELECT total_sessions, viewed AS step1_view_item, carted AS step2_add_to_cart, checkout AS step3_begin_checkout, "
    "payment AS step4_add_payment_info, purchased AS step5_purchase, "
    f"{rpct('viewed', 'total_sessions')} AS pct_view, {rpct('carted', 'total_sessions')} AS pct_cart, "
    f"{rpct('purchased', 'total_sessions')} AS pct_purchase FROM tally")
ORACLE["funnel_dropoff"] = WITH_TALLY + " UNION ALL ".join(
    f"SELECT {i} AS step_order, {text(label)} AS step, {a} AS from_count, {b} AS to_count, {rpct(f'{a} - {b}', a)} AS drop_rate FROM tally"
    for i, label, a, b in funnel.DROPOFF_STEPS)


def _rates(keys: str, having: str = "") -> str:
    return (f"SELECT {keys}, {big('COUNT(*)')} AS sessions, {big('SUM(has_purchase)')} AS purchased, "
            f"{rpct('SUM(has_purchase)', 'COUNT(*)')} AS cvr FROM sess GROUP BY ALL {having}")


ORACLE["funnel_device"] = WITH_SESSIONS + (
    f"SELECT device_category, {big('COUNT(*)')} AS sessions, {big('SUM(has_view_item)')} AS viewed, {big('SUM(has_add_to_cart)')} AS carted, "
    f"{big('SUM(has_purchase)')} AS purchased, {rpct('SUM(has_purchase)', 'COUNT(*)')} AS overall_cvr, "
    f"{rpct('SUM(has_add_to_cart)', 'SUM(has_view_item)')} AS view_to_cart FROM sess GROUP BY ALL")
ORACLE["funnel_day"] = ctes(S, SESSION_CTE, values("days", "session_day, day_name", funnel.DAY_NAMES.items()),
                            "sess_day AS (" + _rates("session_day_of_week AS session_day") + ")") + (
    "SELECT session_day, day_name, sessions, purchased, cvr FROM sess_day LEFT JOIN days USING (session_day)")
ORACLE["funnel_hour"] = WITH_SESSIONS + _rates("session_hour")
ORACLE["funnel_source"] = WITH_SESSIONS + "FROM (" + _rates(
    f"COALESCE(session_source, {text(funnel.DIRECT_SOURCE)}) AS source, COALESCE(session_medium, {text(funnel.NO_MEDIUM)}) AS medium") + (
    ") WHERE sessions >= 50 ORDER BY sessions DESC, source, medium LIMIT 20")
_STAGE = " ".join(f"WHEN {c} = 1 THEN {text(label)}" for c, label in funnel.SANKEY_STAGES)
ORACLE["funnel_sankey"] = WITH_SESSIONS + (
    f"SELECT CASE {_STAGE} ELSE {text(funnel.SANKEY_DEFAULT)} END AS final_stage, {big('COUNT(*)')} AS session_count FROM sess GROUP BY ALL")
_REACHED = ("reached AS (SELECT step_order, step_name, "
            f"{big('COUNT(DISTINCT session_unique_id) FILTER (WHERE wanted IS NULL OR event_name = wanted)')} AS n "
            "FROM stg, asked GROUP BY ALL)")
_ASKED = "asked(step_order, step_name, wanted) AS (VALUES " + ", ".join(
    f"({i}, {text(name)}, {'NULL' if col == 'sessions' else text(col.removeprefix('has_'))})" for i, name, col in funnel.OPEN_FUNNEL_STEPS) + ")"
ORACLE["open_funnel"] = ctes(S, _ASKED, _REACHED, (
    "chained AS (SELECT *, LAG(n) OVER (ORDER BY step_order) AS before FROM reached)")) + (
    "SELECT step_name, step_order, n AS user_count, "
    f"CASE WHEN step_order = 1 THEN 1.0::DOUBLE ELSE {rnd(ratio('n', 'before'), 4)} END AS conversion_rate, "
    f"CASE WHEN step_order = 1 THEN 0.0::DOUBLE ELSE {rnd('1 - ' + ratio('n', 'before'), 4)} END AS drop_off_rate FROM chained")
ORACLE["kpi_summary"] = WITH_TALLY + (
    f"SELECT total_sessions, purchased AS total_purchases, {rpct('purchased', 'total_sessions')} AS overall_cvr, "
    f"(1.0 - {ratio('purchased', 'total_sessions')}) * 100.0 AS bounce_rate, {ratio('purchased', 'total_sessions')} * 100.0 AS cvr_rate, "
    f"{rpct('carted', 'total_sessions', 1)} AS cart_add_rate FROM tally")

# ------------------------------------------------------------------ segments
WITH_STYLES = ctes(S, STYLES_CTE)
ORACLE["session_browsing_style"] = WITH_STYLES + "SELECT * FROM styles"
# Discrete percentile: the smallest value that at least the given share of the group does not exceed.
_SPREAD = ("spread AS (SELECT browsing_style, total_items_viewed AS v, CUME_DIST() OVER (PARTITION BY browsing_style ORDER BY total_items_viewed) AS share "
           "FROM styles)")
_CUTS = "cuts AS (SELECT browsing_style, " + ", ".join(
    f"{rnd(f'MIN(v) FILTER (WHERE share >= {k / 100})', 3)} AS item_viewed_p{k}" for k in segments.QUANTILES) + " FROM spread GROUP BY ALL)"
_MEANS = ("means AS (SELECT browsing_style, CAST(COUNT(session_unique_id) AS BIGINT) AS session_count, "
          f"{rnd('AVG(total_items_viewed)', 3)} AS avg_items_viewed, {rnd('AVG(is_converted) * 100.0', 3)} AS conversion_rate FROM styles GROUP BY ALL)")
STYLE_MART = (_SPREAD, _CUTS, _MEANS, (
    f"mart AS (SELECT browsing_style, session_count, {rnd('session_count * 100.0 / (SELECT SUM(session_count) FROM means)', 1)} AS session_share_percent, "
    "avg_items_viewed, cuts.* EXCLUDE (browsing_style), conversion_rate FROM means JOIN cuts USING (browsing_style))"))
ORACLE["browsing_style_summary"] = ctes(S, STYLES_CTE, *STYLE_MART) + "SELECT * FROM mart"


def _bucket(labels, bounds) -> str:
    """Labels by upper bounds; the last label is open."""
    return "CASE " + " ".join(f"WHEN total_items_viewed <= {b} THEN {text(label)}" for label, b in zip(labels, bounds)) + f" ELSE {text(labels[-1])} END"


DEPTH = _bucket(segments.DEPTH_SEGMENTS, (11, 24, 36))
INTENSITY = _bucket(segments.INTENSITY_SEGMENTS, (24, 36, 84))


def _bucketed(label: str, bucket: str, style: str, averages: str) -> str:
    return (f"b AS (SELECT *, {bucket} AS {label} FROM styles WHERE browsing_style = {text(style)}), "
            f"g AS (SELECT {label}, CAST(COUNT(session_unique_id) AS BIGINT) AS session_count, {averages}, "
            f"{rnd('AVG(is_converted) * 100.0', 2)} AS conversion_rate FROM b GROUP BY ALL), "
            f"seg_mart AS (SELECT *, {rnd('session_count * 100.0 / (SELECT SUM(session_count) FROM g)', 1)} AS share_percent FROM g)")


_DEPTH_MART = _bucketed("depth_segment", DEPTH, segments.DEEP, f"{rnd('AVG(total_items_viewed)', 1)} AS avg_views")
_INTENSITY_MART = _bucketed("intensity_segment", INTENSITY, segments.VARIETY,
                            f"{rnd('AVG(total_items_viewed)', 1)} AS avg_total_views, {rnd('AVG(distinct_categories_viewed)', 1)} AS avg_categories")
ORACLE["deep_specialists"] = ctes(S, STYLES_CTE, _DEPTH_MART) + "SELECT * FROM seg_mart"
ORACLE["variety_seekers"] = ctes(S, STYLES_CTE, _INTENSITY_MART) + "SELECT * FROM seg_mart"
ORACLE["segment_lookup"] = ctes(S, STYLES_CTE, _DEPTH_MART) + "SELECT * FROM seg_mart WHERE depth_segment LIKE '%12-24%'"
# Coverage: the style mart's counts (no row of a NULL session) over all sessions.
ORACLE["segment_coverage"] = ctes(S, SESSION_CTE, STYLES_CTE, _MEANS, (
    "c AS (SELECT COALESCE((SELECT CAST(SUM(session_count) AS BIGINT) FROM means), 0) AS segment_sessions, "
    "(SELECT CAST(COUNT(*) AS BIGINT) FROM sess) AS total_sessions)")) + (
    f"SELECT *, {ratio('segment_sessions', 'total_sessions')} * 100.0 AS coverage_percent FROM c")

# ------------------------------------------------------------------ statistics on segments
SEGMENT_ROWS = {
    "style": "labelled AS (SELECT *, browsing_style AS segment FROM styles)",
    "depth": f"labelled AS (SELECT *, {DEPTH} AS segment FROM styles WHERE browsing_style = {text(segments.DEEP)})",
    "intensity": f"labelled AS (SELECT *, {INTENSITY} AS segment FROM styles WHERE browsing_style = {text(segments.VARIETY)})",
}
COUNTS = ("counted AS (SELECT segment, CAST(COUNT(session_unique_id) AS BIGINT) AS sessions, CAST(SUM(is_converted) AS BIGINT) AS conversions, "
          f"{ratio('SUM(is_converted)', 'COUNT(session_unique_id)')} AS rate FROM labelled GROUP BY ALL)")
# The dashboard's way (Q11): counts rebuilt from the mart's rounded rate.
REBUILT = ("counted AS (SELECT browsing_style AS segment, session_count AS sessions, "
           "CAST(trunc(CAST(session_count AS DOUBLE) * conversion_rate / 100.0) AS BIGINT) AS conversions, conversion_rate / 100.0 AS rate FROM means)")


def wilson_sql(won: str, n: str) -> tuple[str, str, str]:
    """Rate and Wilson interval in percent, in the operation order of ``stats.wilson``."""
    z, z2 = dbl(Z95), dbl(Z95 * Z95)
    size = f"CAST({n} AS DOUBLE)"
    share = f"(CAST({won} AS DOUBLE) / {size})"
    scale = f"(1.0 + {z2} / {size})"
    middle = f"(({share} + {z2} / (2.0 * {size})) / {scale})"
    half = f"({z} * sqrt(({share} * (1.0 - {share}) + {z2} / (4.0 * {size})) / {size}) / {scale})"
    return tuple(f"if({n} = 0, 0.0, {x})" for x in (
        f"{share} * 100.0", f"greatest(0.0, ({middle} - {half}) * 100.0)", f"least(100.0, ({middle} + {half}) * 100.0)"))


def _ci() -> str:
    rate, low, high = wilson_sql("conversions", "sessions")
    return (f"SELECT segment, sessions, {rnd('sessions * 100.0 / (SELECT SUM(sessions) FROM counted)', 1)} AS share_percent, conversions, "
            f"{rate} AS cvr, {low} AS ci_low, {high} AS ci_high, {high} - {rate} AS err_plus, {rate} - {low} AS err_minus FROM counted")


for _kind, _name in (("style", "segment_ci_table"), ("depth", "segment_ci_depth"), ("intensity", "segment_ci_intensity")):
    ORACLE[_name] = ctes(S, STYLES_CTE, SEGMENT_ROWS[_kind], COUNTS) + _ci()
ORACLE["segment_ci_from_mart"] = ctes(S, STYLES_CTE, _MEANS, REBUILT) + _ci()


def tail_sql(x: str, dof: str) -> str:
    """Upper tail of the chi-square distribution, in the operation order of ``stats.chi_square_tail``."""
    half, t = f"({x} / 2.0)", f"sqrt({x} / 2.0)"
    series = (f"list_reduce(list_prepend({{'k': 0::BIGINT, 'term': {t}, 'sum': {t}}}, list_transform(generate_series(1, {ST.SERIES_TERMS}), "
              f"lambda k: {{'k': k, 'term': 0.0::DOUBLE, 'sum': 0.0::DOUBLE}})), lambda a, e: {{'k': e.k, "
              f"'term': a.term * ({x}) / (2.0 * e.k + 1.0), 'sum': a.sum + a.term * ({x}) / (2.0 * e.k + 1.0)}}).sum")
    fraction = (f"list_reduce(list_prepend({t}, list_transform(generate_series(1, {ST.FRACTION_TERMS}), "
                f"lambda k: ({ST.FRACTION_TERMS} + 1 - k)::DOUBLE)), lambda c, k: {t} + (k / 2.0) / c)")
    erfc = (f"if({t} < {dbl(ST.SERIES_BELOW)}, 1.0 - {dbl(ST.TWO_OVER_ROOT_PI)} * exp(-{half}) * {series}, "
            f"exp(-{half}) / ({dbl(ST.ROOT_PI)} * {fraction}))")

    def powers(first: str, step: str) -> str:
        """first * (1 + x/a1 + x^2/(a1 a2) + ...), of dof // 2 terms (even) or (dof - 1) // 2 (odd)."""
        return (f"if(({dof}) < 2, 0.0, {first} * list_reduce(list_prepend({{'term': 1.0::DOUBLE, 'sum': 1.0::DOUBLE}}, "
                f"list_transform(generate_series(1, ({dof}) // 2 - 1), lambda j: {{'term': j::DOUBLE, 'sum': 0.0::DOUBLE}})), "
                f"lambda a, e: {{'term': a.term * {step.format('e.term')}, 'sum': a.sum + a.term * {step.format('e.term')}}}).sum)")
    even = powers(f"exp(-{half})", f"({half} / {{0}})")
    odd = powers(f"(sqrt(2.0 * ({x}) / {dbl(ST.PI)}) * exp(-{half}))", f"(({x}) / (2.0 * {{0}} + 1.0))")
    return (f"CASE WHEN ({x}) IS NULL OR ({dof}) IS NULL OR ({dof}) < 1 THEN NULL WHEN ({x}) <= 0 THEN 1.0 "
            f"WHEN ({dof}) % 2 = 0 THEN {even} ELSE {erfc} + {odd} END")


def p_columns(chi2: str, dof: str) -> str:
    p = f"round({tail_sql(chi2, dof)}, {ST.P_DIGITS})"
    return f"{p} AS p_value, if({p} < {ST.P_TEXT_THRESHOLD}, {text(ST.P_TEXT_BELOW)}, printf('%.4f', {p})) AS p_text"


# Expected cells from the margins; Yates moves each cell towards its expectation by up to one half.
def _cells(by: str = "") -> tuple[str, ...]:
    over = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    side = f"SELECT {keys}segment, sessions, {{o}} AS seen, CAST(sessions AS DOUBLE) * SUM({{o}}) OVER w / SUM(sessions) OVER w AS expected, " \
           f"SUM({{o}}) OVER w AS margin, COUNT(*) OVER w AS k FROM counted WINDOW w AS ({over})"
    group = f"GROUP BY {by}" if by else ""
    return (
        "won AS (" + side.format(o="conversions") + ")", "lost AS (" + side.format(o="(sessions - conversions)") + ")",
        f"gaps AS (SELECT {', '.join(('won.' + by,)) + ', ' if by else ''}won.segment, won.k, won.margin = 0 OR lost.margin = 0 OR won.sessions = 0 AS flat, "
        "abs(won.seen - won.expected) AS a, won.expected AS ea, abs(lost.seen - lost.expected) AS b, lost.expected AS eb "
        f"FROM won JOIN lost USING ({keys}segment))",
        "moved AS (SELECT *, if(k = 2, a - least(0.5, a), a) AS ya, if(k = 2, b - least(0.5, b), b) AS yb FROM gaps)",
        f"tested AS (SELECT {keys}if(COALESCE(bool_or(flat), true), NULL, list_reduce(list_prepend(0.0::DOUBLE, list(ya * ya / NULLIF(ea, 0) + yb * yb / NULLIF(eb, 0) ORDER BY segment)), "
        f"lambda s, x: s + x)) AS chi2, CAST(MAX(k) - 1 AS INTEGER) AS dof, CAST(MAX(k) AS INTEGER) AS segments FROM moved {group})")


for _kind, _name in (("depth", "chi_square_kx2_depth"), ("intensity", "chi_square_kx2_intensity")):
    ORACLE[_name] = ctes(S, STYLES_CTE, SEGMENT_ROWS[_kind], COUNTS, *_cells()) + "SELECT * FROM tested"
_THREE = " UNION ALL ".join(
    f"SELECT {text(test)} AS test, {label} AS segment, session_unique_id, is_converted FROM styles WHERE browsing_style IN ({names(of)})"
    for test, label, of in (("style 2x2", "browsing_style", (segments.VARIETY, segments.DEEP)), ("depth kx2", DEPTH, (segments.DEEP,)),
                            ("intensity kx2", INTENSITY, (segments.VARIETY,))))
ORACLE["chi_square_pvalues"] = ctes(S, STYLES_CTE, f"labelled AS ({_THREE})", COUNTS.replace("SELECT segment", "SELECT test, segment"), *_cells("test")) + (
    f"SELECT test, chi2, dof, segments, {p_columns('chi2', 'dof')} FROM tested")


def chi2_2x2_sql() -> str:
    """Yates-corrected 2x2 statistic of sides a and b, in the operation order of ``stats.chi_square_2x2``."""
    rows = {s: f"CAST(sessions_{s} AS DOUBLE)" for s in "ab"}
    won = "CAST(conversions_a + conversions_b AS DOUBLE)"
    lost = "CAST((sessions_a - conversions_a) + (sessions_b - conversions_b) AS DOUBLE)"
    parts = []
    for s in "ab":
        for seen, margin in ((f"conversions_{s}", won), (f"(sessions_{s} - conversions_{s})", lost)):
            expected = f"({rows[s]} * {margin} / ({rows['a']} + {rows['b']}))"
            gap = f"abs(CAST({seen} AS DOUBLE) - {expected})"
            gap = f"({gap} - least(0.5, {gap}))"
            parts.append(f"{gap} * {gap} / NULLIF({expected}, 0)")
    flat = " OR ".join(f"{x} = 0" for x in (rows["a"], rows["b"], won, lost))
    return f"if({flat}, NULL, {' + '.join(parts)})"


def _sides(pattern_a: str, pattern_b: str, regex: bool) -> tuple[str, ...]:
    """The first segment (by label) that matches each pattern."""
    def hit(p: str) -> str:
        return f"regexp_matches(segment, {text(p)})" if regex else f"segment LIKE {text('%' + p + '%')}"
    return tuple(f"{s} AS (SELECT segment AS segment_{s}, sessions AS sessions_{s}, conversions AS conversions_{s}, rate AS rate_{s} FROM counted "
                 f"WHERE segment = (SELECT MIN(segment) FROM counted WHERE {hit(p)}))" for s, p in (("a", pattern_a), ("b", pattern_b)))


def _compare(bands, default: str) -> str:
    rate, low, high = zip(*(wilson_sql(f"conversions_{s}", f"sessions_{s}") for s in "ab"))
    h = "abs(2.0 * asin(sqrt(rate_a)) - 2.0 * asin(sqrt(rate_b)))"
    label = "CASE " + " ".join(f"WHEN {h} >= {dbl(t)} THEN {text(x)}" for t, x in bands) + f" ELSE {text(default)} END"
    sides = ", ".join(f"segment_{s}, sessions_{s}, conversions_{s}, {rate[i]} AS cvr_{s}, {low[i]} AS ci_low_{s}, {high[i]} AS ci_high_{s}"
                      for i, s in enumerate("ab"))
    return (f"SELECT {sides}, chi2, {p_columns('chi2', '1')}, {h} AS cohens_h, {label} AS effect_label, "
            f"if(rate_b = 0, 0.0, rate_a / rate_b) AS rate_ratio, {low[0]} > {high[1]} AS ci_non_overlap "
            f"FROM (SELECT *, {chi2_2x2_sql()} AS chi2 FROM a, b)")


ORACLE["segment_compare"] = ctes(S, STYLES_CTE, SEGMENT_ROWS["style"], COUNTS, *_sides("Variety", "Deep", False)) + _compare(ST.EFFECT_BANDS, ST.EFFECT_DEFAULT)
ORACLE["segment_compare_intensity"] = ctes(
    S, STYLES_CTE, SEGMENT_ROWS["intensity"], COUNTS, *_sides("Super Heavy|85", "Light|24개 이하", True)) + _compare(
    ST.EFFECT_BANDS_INTENSITY, ST.EFFECT_DEFAULT_INTENSITY)
ORACLE["segment_compare_from_mart"] = ctes(S, STYLES_CTE, _MEANS, REBUILT, *_sides("Variety", "Deep", False)) + _compare(ST.EFFECT_BANDS, ST.EFFECT_DEFAULT)
ORACLE["chi_square_2x2"] = ctes(S, STYLES_CTE, SEGMENT_ROWS["style"], COUNTS, *_sides("Variety", "Deep", False)) + (
    f"SELECT segment_a, segment_b, {chi2_2x2_sql()} AS chi2, 1 AS dof FROM a, b")

# ------------------------------------------------------------------ scoring
ORACLE["engage_lift_score"] = ctes(S, SCORES_CTE) + "SELECT * FROM scores"
ORACLE["lift_weight"] = ctes(S, SESSION_CTE, f"overall AS (SELECT {ratio('SUM(has_purchase)', 'COUNT(*)')} AS base FROM sess)") + "SELECT " + ", ".join(
    f"{rnd('(SELECT ' + ratio('COUNT(*) FILTER (WHERE has_purchase = 1)', 'COUNT(*)') + f' FROM sess WHERE {col} = 1) / NULLIF(base, 0)', 1)} AS {out}"
    for out, col in scoring.LIFT_ACTIONS) + " FROM overall"
ORACLE["lift_long"] = ctes(S, (
    "done AS (SELECT DISTINCT event_name, session_unique_id FROM stg WHERE session_unique_id IS NOT NULL)"), (
    "visits AS (SELECT session_unique_id, bool_or(event_name = 'purchase') AS buyer FROM done GROUP BY ALL)"), (
    f"overall AS (SELECT {ratio('COUNT(*) FILTER (WHERE buyer)', 'COUNT(*)')} AS base FROM visits)"), (
    f"each AS (SELECT event_name, {ratio('COUNT(*) FILTER (WHERE buyer)', 'COUNT(*)')} AS conditional_purchase_rate FROM done JOIN visits USING (session_unique_id) "
    f"WHERE event_name IN ({names(e for e, _ in scoring.LIFT_LONG_ACTIONS)}) GROUP BY ALL)")) + (
    "SELECT event_name, conditional_purchase_rate, conditional_purchase_rate / NULLIF(base, 0) AS lift, "
    f"{rnd('conditional_purchase_rate / NULLIF(base, 0)', 0)} AS score_weight FROM each, overall")
ORACLE["score_short"] = ctes(S, values("short", "event_name, points", sessions.SHORT_SCORE_WEIGHTS.items())) + (
    f"SELECT session_unique_id, CAST(SUM(COALESCE(points, {sessions.DEFAULT_WEIGHT})) AS BIGINT) AS engagement_score "
    "FROM stg LEFT JOIN short USING (event_name) GROUP BY ALL")
ORACLE["core_sessions"] = ctes(S, SCORES_CTE, PATHS_CTE) + (
    "SELECT session_unique_id, user_pseudo_id, engagement_grade, engagement_score, full_path, path_length, COALESCE(is_converted, 0) AS is_converted, "
    "is_converted IS DISTINCT FROM 1 AS is_missed_opportunity FROM scores LEFT JOIN walks USING (session_unique_id) "
    f"WHERE engagement_grade <> {text(scoring.LOW_GRADE)}")

# ------------------------------------------------------------------ carts
# A left line is a (session, item, value); the items' totals come from one row for each session and item.
CART_CTES = (SCORES_CTE, FACTS_CTE, (
    "left_lines AS (SELECT session_unique_id, item_name, item_revenue_calc AS worth, MIN(item_category) AS category FROM stg "
    "SEMI JOIN (SELECT session_unique_id FROM facts WHERE NOT buyer AND "
    f"engagement_grade IN ({names(scoring.CORE_GRADES)})) USING (session_unique_id) WHERE event_name = 'add_to_cart' GROUP BY ALL)"), (
    "left_items AS (SELECT session_unique_id, item_name, MAX(category) AS category, SUM(worth) AS worth, COUNT(*) AS lines FROM left_lines GROUP BY ALL)"), (
    "cart AS (SELECT item_name, MAX(category) AS item_category, CAST(COUNT(*) AS BIGINT) AS abandoned_session_count, "
    f"SUM(worth) AS total_lost_revenue, {rnd('SUM(worth) / SUM(lines)', 0)} AS avg_lost_value FROM left_items GROUP BY ALL)"))
_NOT_OUTLIER = " AND ".join(f"COALESCE(item_name NOT ILIKE {text('%' + n + '%')}, true)" for n in cart.EXCLUDED_ITEMS)
CLEAN = f"clean AS (SELECT * FROM cart WHERE {_NOT_OUTLIER})"
_IS_APPAREL = " OR ".join(f"item_category LIKE {text('%' + m + '%')}" for m in cart.APPAREL_MARKERS)
MAIN = (f"sorted_cart AS (SELECT *, CASE WHEN item_category IS NULL THEN 'Other' WHEN item_category LIKE '%{cart.BAGS}%' THEN 'Bags' WHEN {_IS_APPAREL} THEN 'Apparel' "
        f"WHEN item_category LIKE '%{cart.ACCESSORIES_MARKER}%' THEN 'Accessories' ELSE 'Other' END AS main_category FROM clean)")
WITH_CART = ctes(S, *CART_CTES, CLEAN, MAIN)
ORACLE["cart_abandon"] = WITH_CART + "SELECT * FROM cart"
ORACLE["exclude_items"] = WITH_CART + "SELECT * FROM clean"
ORACLE["main_category"] = WITH_CART + "SELECT item_name, item_category, main_category FROM sorted_cart"
ORACLE["category_loss_rollup"] = WITH_CART + (
    "SELECT main_category, CAST(COUNT(*) AS BIGINT) AS items, CAST(SUM(abandoned_session_count) AS BIGINT) AS abandoned_sessions, SUM(total_lost_revenue) AS lost_value, "
    f"{ratio('SUM(total_lost_revenue)', '(SELECT SUM(total_lost_revenue) FROM sorted_cart)')} * 100.0 AS loss_share_percent, "
    f"{ratio('SUM(abandoned_session_count)', '(SELECT SUM(abandoned_session_count) FROM sorted_cart)')} * 100.0 AS abandon_share_percent, "
    f"{ratio('SUM(total_lost_revenue)', 'SUM(abandoned_session_count)')} AS loss_per_abandon FROM sorted_cart GROUP BY ALL")
ORACLE["category_filter_loss"] = WITH_CART + (
    "SELECT category_items, category_lost, category_abandons, total_lost, "
    f"{ratio('category_lost', 'total_lost')} * 100.0 AS loss_share_percent, {ratio('category_lost', 'category_abandons')} AS loss_per_abandon FROM ("
    "SELECT CAST(COUNT(*) AS BIGINT) AS category_items, SUM(total_lost_revenue) AS category_lost, CAST(SUM(abandoned_session_count) AS BIGINT) AS category_abandons, "
    f"(SELECT SUM(total_lost_revenue) FROM clean) AS total_lost FROM clean WHERE item_category ILIKE '%{cart.BAGS}%')")
ORACLE["cart_totals"] = WITH_CART + "SELECT SUM(total_lost_revenue) AS total_lost, CAST(SUM(abandoned_session_count) AS BIGINT) AS total_abandons FROM clean"
ORACLE["loss_count_correlation"] = WITH_CART + f"SELECT {rnd('corr(avg_lost_value, abandoned_session_count)', 10)} AS pearson_r FROM clean"
for _by, _name in (("total_lost_revenue", "cart_top_n_value"), ("abandoned_session_count", "cart_top_n_sessions"), ("avg_lost_value", "cart_top_n_average")):
    ORACLE[_name] = WITH_CART + f"SELECT * FROM clean ORDER BY {_by} DESC, item_name NULLS LAST LIMIT 10"
ORACLE["category_top_n"] = WITH_CART + (
    f"SELECT main_category, rank, item_name, left(replace(item_name, {text(cart.GOOGLE_PREFIX)}, ''), {cart.SHORT_NAME_LEN}) AS item_short, "
    "abandoned_session_count, total_lost_revenue, CAST(trunc(CASE WHEN avg_lost_value > 0 THEN avg_lost_value "
    "ELSE COALESCE(total_lost_revenue / NULLIF(abandoned_session_count, 0), 0) END) AS BIGINT) AS avg_lost_int, "
    "CAST(trunc(total_lost_revenue / 1000.0) AS BIGINT) AS lost_k FROM (SELECT *, "
    "CAST(row_number() OVER (PARTITION BY main_category ORDER BY total_lost_revenue DESC, item_name NULLS LAST) AS INTEGER) AS rank FROM sorted_cart) WHERE rank <= 2")

# ------------------------------------------------------------------ promotions
PROMO_CTE = (f"shown AS (SELECT promotion_name, CAST(COUNT(*) FILTER (WHERE event_name = 'view_promotion') AS BIGINT) AS impressions, "
             f"CAST(COUNT(*) FILTER (WHERE event_name = 'select_promotion') AS BIGINT) AS clicks FROM stg WHERE promotion_name <> {text(NOT_SET)} GROUP BY ALL)",
             f"rated AS (SELECT *, {rpct('clicks', 'impressions')} AS ctr_percent FROM shown WHERE impressions > {promo.MIN_IMPRESSIONS})")
ORACLE["promo_performance"] = ctes(S, *PROMO_CTE) + "SELECT * FROM rated"
QUALITY_CTES = (*PROMO_CTE, SCORES_CTE, FACTS_CTE, (
    "pressed AS (SELECT promotion_name, session_unique_id, facts.* EXCLUDE (session_unique_id) FROM stg LEFT JOIN facts USING (session_unique_id) "
    f"WHERE event_name = 'select_promotion' AND promotion_name <> {text(NOT_SET)})"), (
    "measured AS (SELECT promotion_name, CAST(COUNT(DISTINCT session_unique_id) AS BIGINT) AS click_sessions, "
    f"{rnd('AVG(engagement_score)', 1)} AS avg_session_score, CAST(COUNT(*) FILTER (WHERE engagement_grade = {text(friction.HIGH)}) AS BIGINT) AS high_intent_session_count, "
    f"{rpct('COUNT(*) FILTER (WHERE buyer)', 'COUNT(DISTINCT session_unique_id)')} AS promo_cvr FROM pressed GROUP BY ALL)"), (
    "quality AS (SELECT promotion_name, ctr_percent, click_sessions, avg_session_score, high_intent_session_count, promo_cvr, "
    f"CASE WHEN ctr_percent IS NULL OR avg_session_score IS NULL THEN {text(promo.POOR)} "
    f"WHEN ctr_percent >= {promo.CTR_CUT} THEN if(avg_session_score >= {promo.SCORE_CUT}, {text(promo.STAR)}, {text(promo.CLICKBAIT)}) "
    f"ELSE if(avg_session_score >= {promo.SCORE_CUT}, {text(promo.HIDDEN_GEM)}, {text(promo.POOR)}) END AS promo_status "
    "FROM measured LEFT JOIN (SELECT promotion_name, ctr_percent FROM rated) USING (promotion_name))"))
WITH_QUALITY = ctes(S, *QUALITY_CTES)
ORACLE["promo_quality"] = WITH_QUALITY + "SELECT * FROM quality"
ORACLE["promo_summary"] = WITH_QUALITY + (
    "SELECT promotion_name, ctr_percent, promo_cvr, click_sessions, promo_status, promotion_name || '<br>CVR: ' || printf('%.1f', promo_cvr) || '%' AS label FROM quality")
ORACLE["hidden_gems"] = WITH_QUALITY + (
    f"SELECT promotion_name, ctr_percent, avg_session_score, promo_cvr FROM quality WHERE promo_status = {text(promo.HIDDEN_GEM)} "
    "ORDER BY click_sessions DESC, promotion_name LIMIT 1")


# ------------------------------------------------------------------ friction, time to purchase
def _friction(weight: str) -> str:
    """``weight``: what a session counts for, its staged rows (n) or 1."""
    return ctes(S, SCORES_CTE, FACTS_CTE, "rows_by AS (SELECT device_category, session_unique_id, COUNT(*) AS n FROM stg GROUP BY ALL)", (
        f"by_device AS (SELECT device_category, CAST(COUNT(*) AS BIGINT) AS total_sessions, {big(f'SUM({weight}) FILTER (WHERE engagement_grade = {text(friction.HIGH)})')} AS high, "
        f"COALESCE({big(f'SUM({weight}) FILTER (WHERE buyer AND engagement_grade = {text(friction.HIGH)})')}, 0) AS won "
        "FROM rows_by JOIN facts USING (session_unique_id) GROUP BY ALL)"),
        f"rates AS (SELECT *, {ratio('won', 'high')} AS cvr FROM by_device WHERE high > 0)") + (
        f"SELECT device_category, total_sessions, high AS high_intent_users, {rpct('high', 'total_sessions', 1)} AS high_intent_ratio, "
        f"{rnd('cvr * 100.0', 1)} AS high_intent_cvr_percent, "
        f"{rnd(f'cvr / NULLIF((SELECT cvr FROM rates WHERE device_category = {text(friction.BASELINE_DEVICE)}), 0) * 100.0', 0)} AS efficiency_index_vs_pc FROM rates")


ORACLE["device_friction"] = _friction("n")
ORACLE["device_friction_by_session"] = _friction("1")
_TIME = "CASE " + " ".join(f"WHEN minutes_to_buy < {b} THEN {text(x)}" for b, x in friction.TIME_BUCKETS) + f" ELSE {text(friction.TIME_BUCKET_LAST)} END"
ORACLE["time_to_conversion"] = ctes(S, (
    "last_buy AS (SELECT session_unique_id AS id, MAX(event_timestamp) AS bought_at FROM stg WHERE event_name = 'purchase' GROUP BY ALL)"), (
    "opened AS (SELECT session_unique_id AS id, MIN(event_timestamp) AS began_at, SUM(item_revenue_calc) AS spent FROM stg GROUP BY ALL)"), (
    "waits AS (SELECT (epoch_us(bought_at) - epoch_us(began_at)) // 60000000 AS minutes_to_buy, spent "
    "FROM last_buy JOIN opened ON last_buy.id IS NOT DISTINCT FROM opened.id)")) + (
    f"SELECT minutes_to_buy, {_TIME} AS time_bucket, CAST(COUNT(*) AS BIGINT) AS session_count, {rnd('AVG(spent)', 1)} AS avg_order_value FROM waits GROUP BY ALL")

# ------------------------------------------------------------------ baskets
TIER_CTES = ("seen_prices AS (SELECT item_name, item_price FROM stg WHERE event_name = 'view_item' AND item_price > 0)",
             "shares AS (SELECT item_price, CUME_DIST() OVER (ORDER BY item_price) AS share FROM seen_prices)",
             "cutoffs AS (SELECT MIN(item_price) FILTER (WHERE share >= 0.33) AS p33_cutoff, MIN(item_price) FILTER (WHERE share >= 0.66) AS p66_cutoff FROM shares)",
             "mean_prices AS (SELECT item_name, AVG(item_price) AS avg_price FROM seen_prices GROUP BY ALL)",
             f"tiers AS (SELECT item_name, avg_price, list_extract(['{basket.LOW}', '{basket.MID}', '{basket.HIGH}'], "
             "1 + CAST(avg_price >= p33_cutoff OR avg_price >= p66_cutoff AS INTEGER) + CAST(avg_price >= p66_cutoff AS INTEGER)) AS price_tier, "
             "p33_cutoff, p66_cutoff FROM mean_prices, cutoffs)")
ORACLE["price_tier"] = ORACLE["price_tier_alt"] = ctes(S, *TIER_CTES) + "SELECT * FROM tiers"
# Pairs from a transaction's list of sold lines: each line meets every line of a later name.
PAIR_CTES = ("tickets AS (SELECT transaction_id, list({'visit': session_unique_id, 'name': item_name}) AS sold FROM stg "
             "WHERE event_name = 'purchase' AND transaction_id IS NOT NULL AND item_name IS NOT NULL GROUP BY ALL)",
             "firsts AS (SELECT transaction_id, sold, unnest(sold) AS a FROM tickets)",
             "met AS (SELECT transaction_id, a.visit AS session_unique_id, a.name AS product_A, "
             "unnest(list_transform(list_filter(sold, lambda x: x.name > a.name), lambda x: x.name)) AS product_B FROM firsts)")
ORACLE["product_association"] = ctes(S, *PAIR_CTES) + (
    "SELECT session_unique_id, transaction_id, product_A, product_B, CAST(COUNT(*) AS BIGINT) AS line_pairs FROM met GROUP BY ALL")


def _bundle(mid: str) -> str:
    either = [(basket.HIGH, basket.LOW), (mid, basket.HIGH)]
    add_on = " OR ".join(f"(tier_A, tier_B) IN (({text(x)}, {text(y)}), ({text(y)}, {text(x)}))" for x, y in either)
    return ctes(S, SCORES_CTE, FACTS_CTE, *TIER_CTES, *PAIR_CTES, (
        "sales AS (SELECT product_A, product_B, CAST(COUNT(DISTINCT transaction_id) AS BIGINT) AS pair_sales_count, "
        f"{rnd('AVG(engagement_score)', 1)} AS avg_buyer_score, {rpct(f'COUNT(*) FILTER (WHERE engagement_grade = {text(friction.HIGH)})', 'COUNT(*)', 1)} AS high_intent_ratio "
        "FROM met LEFT JOIN facts USING (session_unique_id) GROUP BY ALL)"), (
        f"priced AS (SELECT sales.*, {rnd('ta.avg_price', 3)} AS price_A, ta.price_tier AS tier_A, {rnd('tb.avg_price', 3)} AS price_B, tb.price_tier AS tier_B "
        "FROM sales LEFT JOIN tiers ta ON ta.item_name = product_A LEFT JOIN tiers tb ON tb.item_name = product_B "
        f"WHERE pair_sales_count >= {basket.MIN_PAIR_SALES})")) + (
        f"SELECT *, CASE WHEN tier_A IS NULL OR tier_B IS NULL THEN {text(basket.GENERAL)} WHEN {add_on} THEN {text(basket.ADD_ON)} "
        f"WHEN tier_A <> tier_B THEN {text(basket.GENERAL)} WHEN tier_A = {text(basket.HIGH)} THEN {text(basket.PREMIUM)} "
        f"WHEN tier_A = {text(basket.MID)} THEN {text(basket.VOLUME)} ELSE {text(basket.GENERAL)} END AS bundle_strategy_type FROM priced")


ORACLE["bundle_strategy"] = _bundle(basket.REFERENCE_MID_NAME)
ORACLE["bundle_strategy_fixed"] = _bundle(basket.MID)
ORACLE["market_basket_orders"] = ctes(
    "orders_sold AS (SELECT l_orderkey AS o, list(p_name) AS sold FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)",
    "firsts AS (SELECT o, sold, unnest(sold) AS a FROM orders_sold)",
    "met AS (SELECT o, a AS product_A, unnest(list_filter(sold, lambda x: x > a)) AS product_B FROM firsts)") + (
    "SELECT product_A, product_B, CAST(COUNT(DISTINCT o) AS BIGINT) AS pair_orders, CAST(COUNT(*) AS BIGINT) AS pair_rows FROM met GROUP BY ALL")

# ------------------------------------------------------------------ marts through files
ORACLE["mart_csv_roundtrip"] = ORACLE["browsing_style_summary"]
ORACLE["events_export_roundtrip"] = WITH_STG + (
    "SELECT event_date, CAST(COUNT(*) AS BIGINT) AS staged_rows, CAST(COUNT(DISTINCT event_id) AS BIGINT) AS events, SUM(item_revenue_calc) AS revenue FROM stg "
    "GROUP BY ALL")

# ------------------------------------------------------------------ daily states
# A piece is an hour of a session, cut evenly if more than 20,000 rows fall into it.
ORACLE["session_path_pieces"] = ctes(S, (
    "busy AS (SELECT *, date_trunc('hour', event_timestamp) AS hour, COUNT(*) OVER (PARTITION BY session_unique_id, date_trunc('hour', event_timestamp)) AS n FROM stg)"), (
    "cut AS (SELECT *, CASE WHEN n > 20000 THEN CAST(floor(3600000000 / ceil(n / 20000)) AS BIGINT) ELSE 3600000000 END AS width, "
    "epoch_us(event_timestamp) - epoch_us(hour) AS into_hour FROM busy)")) + (
    "SELECT session_unique_id, make_timestamp(epoch_us(hour) + into_hour - into_hour % width) AS piece, "
    f"array_to_string(list(event_name ORDER BY event_timestamp, event_id), {text(sessions.PATH_SEPARATOR)}) AS path, CAST(COUNT(*) AS BIGINT) AS path_length, "
    "CAST(bool_or(event_name = 'purchase') AS INTEGER) AS is_converted FROM cut GROUP BY ALL")
ORACLE["session_facts_incremental"] = ctes(S, SESSION_CTE, (
    "more AS (SELECT session_unique_id AS sid, CAST(COUNT(*) AS BIGINT) AS path_length, "
    "CAST(COUNT(item_name) FILTER (WHERE event_name = 'view_item') AS BIGINT) AS total_items_viewed, "
    "CAST(COUNT(DISTINCT item_category) FILTER (WHERE event_name = 'view_item') AS BIGINT) AS categories, "
    "MAX(event_timestamp) FILTER (WHERE event_name = 'purchase') AS purchased_at, SUM(item_revenue_calc) AS total_revenue FROM stg GROUP BY ALL)")) + (
    "SELECT sess.* EXCLUDE (has_search), more.* EXCLUDE (sid) FROM sess JOIN more ON session_unique_id IS NOT DISTINCT FROM sid")
# Estimates themselves are random; that they lie within their bound is not.
_VIEWED = "FROM stg WHERE event_name = 'view_item' AND item_price > 0"
ORACLE["price_cutoffs_sketch"] = WITH_STG + (
    "SELECT q.quantile, v.n_days, v.n_views, true AS within_bound FROM (VALUES (0.33::DOUBLE), (0.66::DOUBLE)) q(quantile), "
    f"(SELECT CAST(COUNT(DISTINCT event_date) AS BIGINT) AS n_days, CAST(COUNT(*) AS BIGINT) AS n_views {_VIEWED}) v WHERE n_views > 0")
ORACLE["item_prices_from_days"] = WITH_STG + f"SELECT item_name, AVG(item_price) AS avg_price {_VIEWED} GROUP BY ALL"
ORACLE["style_quantiles_sketch"] = WITH_STYLES + (
    f"SELECT browsing_style, CAST(percent AS INTEGER) AS percent, CAST(COUNT(*) AS BIGINT) AS sessions, true AS within_bound "
    f"FROM styles, (SELECT unnest({list(segments.QUANTILES)}) AS percent) GROUP BY ALL")
ORACLE["open_funnel_sketch"] = ctes(S, _ASKED, _REACHED) + (
    "SELECT step_order, step_name, (SELECT CAST(COUNT(DISTINCT event_date) AS BIGINT) FROM stg) AS n_days, n AS user_count, true AS within_bound FROM reached")
