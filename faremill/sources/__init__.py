from faremill.sources.drift import cast_losses, drift_impact, drift_table, schema_drift
from faremill.sources.landing import (
    LandedPeriod,
    LandingZone,
    conform,
    landed_schemas,
    period_coverage,
    read_enforced,
    read_landed,
    scan_declared,
    scan_periods,
)

__all__ = [
    "LandedPeriod",
    "LandingZone",
    "cast_losses",
    "conform",
    "drift_impact",
    "drift_table",
    "landed_schemas",
    "period_coverage",
    "read_enforced",
    "read_landed",
    "scan_declared",
    "scan_periods",
    "schema_drift",
]
