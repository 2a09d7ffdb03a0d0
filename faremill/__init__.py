"""faremill: contract-driven trip analytics on plain PySpark."""

from faremill.contracts import (
    GREEN_TRIPS,
    PAYMENT_CODES,
    RATECODES,
    TRIP_CONTRACT,
    VENDOR_CODES,
    YELLOW_TRIPS,
    CodeMap,
    ColumnSpec,
    PeriodRange,
    Roles,
    TableContract,
    TripKind,
)
from faremill.errors import MissingColumnError, MissingRoleError, NoLandedPeriodsError, SchemaDriftError
from faremill.session import build_session

__all__ = [
    "GREEN_TRIPS",
    "PAYMENT_CODES",
    "RATECODES",
    "TRIP_CONTRACT",
    "VENDOR_CODES",
    "YELLOW_TRIPS",
    "CodeMap",
    "ColumnSpec",
    "MissingColumnError",
    "MissingRoleError",
    "NoLandedPeriodsError",
    "PeriodRange",
    "Roles",
    "SchemaDriftError",
    "TableContract",
    "TripKind",
    "build_session",
]
