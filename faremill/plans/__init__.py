from faremill.plans.answers import (
    avg_passengers_by_hour,
    daypart_profile,
    hour_extremes,
    hours_wide,
    period_means,
    revenue_by_month,
    revenue_report,
    revenue_report_sql,
    ticket_by_month,
)
from faremill.plans.layers import (
    LakehouseConfig,
    bronze,
    build_bronze,
    build_gold,
    build_lakehouse,
    build_silver,
    gold,
    silver,
)

__all__ = [
    "LakehouseConfig",
    "avg_passengers_by_hour",
    "bronze",
    "build_bronze",
    "build_gold",
    "build_lakehouse",
    "build_silver",
    "daypart_profile",
    "gold",
    "hour_extremes",
    "hours_wide",
    "period_means",
    "revenue_by_month",
    "revenue_report",
    "revenue_report_sql",
    "silver",
    "ticket_by_month",
]
