from pacelake.operators.metrics import (  # noqa: F401
    band_label,
    band_stats,
    bucket,
    bucket_counts,
    count_where,
    debut_cohorts,
    distinct_per_group,
    growth_over_prior,
    latest_by_key,
    lookup_label,
    pct_where,
    round_half_up,
    running_best,
    share_pct,
    quantiles,
    top_k,
)
from pacelake.operators.quality import (  # noqa: F401
    audit_star_schema,
    compare_results,
    null_counts,
    numeric_summary,
    profile_table,
    shape,
    validate_event_specs,
    validate_json_specs,
)
