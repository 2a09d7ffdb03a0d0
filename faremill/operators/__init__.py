from faremill.operators.clean import (
    cleaning_waterfall,
    derive_calendar,
    duplicate_count,
    duplicate_examples,
    first_per_key,
    in_time_order,
    survivor_order,
    time_travel,
)
from faremill.operators.enrich import decode_codes, preview, project
from faremill.operators.profile import (
    anomaly_counts,
    avg_zero_impact,
    chargeback_impact,
    chargeback_impact_one_pass,
    code_distribution,
    completeness,
    daily_counts,
    filter_interaction,
    group_share,
    grouped_profile,
    hourly_profile,
    metric_extremes,
    monthly_chargebacks,
    monthly_profile,
    null_code_origin,
    null_profile,
    simultaneous_nulls,
    table_size,
)

__all__ = [
    "anomaly_counts",
    "avg_zero_impact",
    "chargeback_impact",
    "chargeback_impact_one_pass",
    "cleaning_waterfall",
    "code_distribution",
    "completeness",
    "daily_counts",
    "decode_codes",
    "derive_calendar",
    "duplicate_count",
    "duplicate_examples",
    "filter_interaction",
    "first_per_key",
    "group_share",
    "grouped_profile",
    "hourly_profile",
    "in_time_order",
    "metric_extremes",
    "monthly_chargebacks",
    "monthly_profile",
    "null_code_origin",
    "null_profile",
    "preview",
    "project",
    "simultaneous_nulls",
    "survivor_order",
    "table_size",
    "time_travel",
]
