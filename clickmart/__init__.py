"""Clickstream mart library on PySpark.

Every operator is a plain function ``DataFrame(s) -> DataFrame``; thresholds,
weights and labels are keyword parameters whose defaults reproduce the
reference marts.  Nothing is collected to the driver except the final rows a
caller asks for.

Typical use::

    from clickmart import get_session, read_events, build_all, write_all
    spark = get_session()
    models = build_all(read_events(spark, "s3://.../events", "20201201", "20201231"))
    write_all(models, "s3://.../marts")
"""

from clickmart.conf import ensure_checkpoint_dir, get_session, scale_conf  # noqa: F401
from clickmart.operators.basket import bundle_strategy, price_tier, product_association  # noqa: F401
from clickmart.operators.cart import (  # noqa: F401
    abandoned_sessions, cart_abandon, cart_top_n, cart_totals, category_filter_loss, category_loss_rollup,
    category_top_n, exclude_items, loss_count_correlation, main_category)
from clickmart.operators.friction import device_friction, time_to_conversion  # noqa: F401
from clickmart.operators.funnel import (  # noqa: F401
    funnel_day, funnel_device, funnel_dropoff, funnel_hour, funnel_overall, funnel_sankey, funnel_source,
    kpi_summary, open_funnel)
from clickmart.operators.promo import hidden_gems, promo_performance, promo_quality, promo_summary  # noqa: F401
from clickmart.operators.scoring import (  # noqa: F401
    core_sessions, engage_lift_score, lift_long, lift_weight, percent_rank_desc, score_short)
from clickmart.operators.segments import (  # noqa: F401
    browsing_style, browsing_style_summary, deep_specialists, segment_coverage, segment_lookup, variety_seekers)
from clickmart.operators.sessions import session_features, session_funnel, session_level, session_paths  # noqa: F401
from clickmart.operators.significance import (  # noqa: F401
    chi_square_segments, mart_counts, segment_ci_table, segment_compare, segment_counts, with_p_value)
from clickmart.operators.staging import stage_events  # noqa: F401
from clickmart.plans.pipeline import build_all, write_all  # noqa: F401
from clickmart.sources.io import load_marts, read_events, read_mart_csv, write_events, write_marts  # noqa: F401
from clickmart.streaming.staging import stage_events_stream  # noqa: F401
