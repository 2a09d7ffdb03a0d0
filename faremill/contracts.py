"""Table contract, code maps and valid window: the data that drives every operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from faremill.errors import MissingRoleError

REQUIRED = "required"  # must be in at least one landed file
FILLED = "filled"  # typed NULL where no file has it
AS_LANDED = "as_landed"  # kept when landed, not invented otherwise
DERIVED = "derived"  # added by a layer, never landed


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: DataType
    comment: str
    presence: str = FILLED

    def accepts(self, landed: DataType) -> bool:
        """Whether `landed` may be cast to the contract type without a run-time failure by design.

        Numbers may change width or kind (a fraction is cut toward zero), and the
        time types convert among themselves. Text never turns into a number.
        """
        if landed == self.data_type:
            return True
        times = (TimestampType, TimestampNTZType, DateType)
        return (isinstance(landed, NumericType) and isinstance(self.data_type, NumericType)) or (
            isinstance(landed, times) and isinstance(self.data_type, times)
        )


@dataclass(frozen=True)
class Roles:
    """The columns that play the parts which cleaning rules and answers speak of.

    A part that no column plays is None: without a dropoff the layers have no time-order rule, and an
    answer that needs a missing part raises `MissingRoleError` before any job.
    """

    pickup: str
    dropoff: str | None = None
    passengers: str | None = None
    amount: str | None = None

    def column(self, part: str) -> str:
        name = getattr(self, part)
        if name is None:
            raise MissingRoleError(f"no column plays the part {part!r}")
        return name

    def played(self) -> tuple[str, ...]:
        return tuple(c for c in (self.pickup, self.dropoff, self.passengers, self.amount) if c is not None)


@dataclass(frozen=True)
class TableContract:
    columns: tuple[ColumnSpec, ...]

    def find(self, name: str) -> ColumnSpec | None:
        """Look a column up without regard to case, as Spark resolves names."""
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)

    def landed(self) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.presence != DERIVED)

    def struct(self, names: Iterable[str] | None = None) -> StructType:
        """`StructType` of the landed columns, or of `names`, for an enforced-schema read."""
        if names is None:
            specs = [c for c in self.columns if c.presence in (REQUIRED, FILLED)]
        else:
            specs = [self.find(n) for n in names]
        return StructType([StructField(c.name, c.data_type, True) for c in specs])

    def describe(self, df: DataFrame) -> DataFrame:
        """Attach the contract's comments to the columns `df` has; the others stay as they are."""
        cols = []
        for f in df.schema.fields:
            spec = self.find(f.name)
            if spec is None:
                cols.append(F.col(f"`{f.name}`"))
            else:
                metadata = {**f.metadata, "comment": spec.comment}
                cols.append(F.col(f"`{f.name}`").alias(f.name, metadata=metadata))
        return df.select(*cols)


@dataclass(frozen=True)
class CodeMap:
    """Known codes of one column with their descriptions, and the text for unknown codes."""

    code_col: str
    desc_col: str
    entries: Mapping[int, str] = field(hash=False)
    unknown_prefix: str = "Outro/Inválido: "


@dataclass(frozen=True)
class PeriodRange:
    """The months from the first to the last configured one, as a half-open time window."""

    first: tuple[int, int]
    last: tuple[int, int]

    @classmethod
    def of(cls, years: Sequence[int | str], months: Sequence[int | str]) -> PeriodRange:
        periods = sorted((int(y), int(m)) for y in years for m in months)
        if not periods:
            raise ValueError("at least one year and one month are needed")
        return cls(periods[0], periods[-1])

    @property
    def start(self) -> datetime:
        return datetime(*self.first, 1)

    @property
    def end(self) -> datetime:
        year, month = self.last
        return datetime(year + month // 12, month % 12 + 1, 1)

    def bounds(self) -> tuple[Column, Column]:
        """Typed literals, so that no cast lands on the column side of a comparison."""
        return tuple(F.lit(t.isoformat(sep=" ")).cast(TimestampNTZType()) for t in (self.start, self.end))

    def contains(self, ts: str | Column) -> Column:
        ts = F.col(ts) if isinstance(ts, str) else ts
        lo, hi = self.bounds()
        return (ts >= lo) & (ts < hi)

    def excludes(self, ts: str | Column) -> Column:
        ts = F.col(ts) if isinstance(ts, str) else ts
        lo, hi = self.bounds()
        return (ts < lo) | (ts >= hi)

    def covers(self, year: str, month: str) -> Column:
        """Whether a (year, month) pair is in the range; on partition columns it prunes."""
        ordinal = F.col(year) * 12 + F.col(month)
        return ordinal.between(*[y * 12 + m for y, m in (self.first, self.last)])


@dataclass(frozen=True)
class TripKind:
    """All that tells one type of record from another: its landed name, contract, parts, identity, published columns and codes.

    The time rules run before the de-duplication, which is right only if all rows of a key share their
    verdict. So the columns of pickup and dropoff must be in the key.
    """

    name: str
    contract: TableContract
    roles: Roles
    key: tuple[str, ...]
    columns: tuple[str, ...]
    code_maps: tuple[CodeMap, ...] = ()

    def __post_init__(self) -> None:
        unknown = [c for c in (*self.roles.played(), *self.key, *self.columns) if self.contract.find(c) is None]
        if unknown:
            raise ValueError(f"the contract of {self.name} has no columns {sorted(set(unknown))}")
        key = {c.lower() for c in self.key}
        outside = [c for c in (self.roles.pickup, self.roles.dropoff) if c is not None and c.lower() not in key]
        if outside:
            raise ValueError(f"the key of {self.name} lacks the time columns {outside}")


# --- fixed values: code descriptions and labels of the published trip-record dictionary ---
VENDOR_CODES = CodeMap(
    "VendorID",
    "vendor_desc",
    {
        1: "Creative Mobile Technologies (CMT)",
        2: "VeriFone Inc.",
    },
)
RATECODES = CodeMap(
    "RatecodeID",
    "ratecode_desc",
    {
        1: "Standard rate",
        2: "JFK",
        3: "Newark",
        4: "Nassau or Westchester",
        5: "Negotiated fare",
        6: "Group ride",
    },
)
PAYMENT_CODES = CodeMap(
    "payment_type",
    "payment_desc",
    {
        0: "Flex Fare trip",
        1: "Credit card",
        2: "Cash",
        3: "No charge",
        4: "Dispute",
        5: "Unknown",
        6: "Voided trip",
    },
)
TRIP_TYPE_CODES = CodeMap(
    "trip_type",
    "trip_type_desc",
    {
        1: "Street-hail",
        2: "Dispatch",
    },
)
MONTH_LABELS = {1: "Jan", 2: "Fev", 3: "Mar", 4: "Abr", 5: "Mai"}
PERIOD_MEAN_LABEL = "Média do período"
ABSENT_TYPE = "--- AUSENTE ---"

# Columns that are empty together when a vendor skips the secondary fields.
SECONDARY_FIELDS = (
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "airport_fee",
)
ANSWER_FIELDS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "total_amount",
)
DEDUP_KEY = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
)
GOLD_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "total_amount",
    "RatecodeID",
    "payment_type",
    "year",
    "month",
)
# --- end of fixed values ---

_LONG, _DOUBLE, _TEXT, _INT = LongType(), DoubleType(), StringType(), IntegerType()
# Pickup and dropoff are wall-clock readings of a meter. Without a zone, their
# month and hour cannot depend on the session's time zone.
_CLOCK = TimestampNTZType()

TRIP_CONTRACT = TableContract(
    (
        ColumnSpec("VendorID", _LONG, "Code of the technology provider that sent the record", REQUIRED),
        ColumnSpec("tpep_pickup_datetime", _CLOCK, "Meter switched on: start of the trip", REQUIRED),
        ColumnSpec("tpep_dropoff_datetime", _CLOCK, "Meter switched off: end of the trip", REQUIRED),
        ColumnSpec("passenger_count", _LONG, "Passengers on board as entered by the driver", FILLED),
        ColumnSpec("trip_distance", _DOUBLE, "Metered distance in miles", FILLED),
        ColumnSpec("RatecodeID", _LONG, "Code of the rate in force at the trip's end; 99 means unknown", FILLED),
        ColumnSpec("store_and_fwd_flag", _TEXT, "Y when the record waited in the vehicle's memory, else N", FILLED),
        ColumnSpec("PULocationID", _LONG, "Zone of the pickup", REQUIRED),
        ColumnSpec("DOLocationID", _LONG, "Zone of the dropoff", REQUIRED),
        ColumnSpec("payment_type", _LONG, "Code of the payment method", FILLED),
        ColumnSpec("fare_amount", _DOUBLE, "Time-and-distance fare in USD", FILLED),
        ColumnSpec("extra", _DOUBLE, "Other surcharges in USD", FILLED),
        ColumnSpec("mta_tax", _DOUBLE, "Transit tax tied to the metered rate, in USD", FILLED),
        ColumnSpec("tip_amount", _DOUBLE, "Card tips in USD; cash tips aren't recorded", FILLED),
        ColumnSpec("tolls_amount", _DOUBLE, "Sum of the trip's tolls in USD", FILLED),
        ColumnSpec("improvement_surcharge", _DOUBLE, "Improvement surcharge at flag drop, in USD", FILLED),
        ColumnSpec("total_amount", _DOUBLE, "Amount charged to the passenger in USD, cash tips excluded", REQUIRED),
        ColumnSpec("congestion_surcharge", _DOUBLE, "State congestion surcharge in USD", FILLED),
        ColumnSpec("airport_fee", _DOUBLE, "Airport pickup fee in USD", FILLED),
        ColumnSpec("cbd_congestion_fee", _DOUBLE, "Congestion-zone fee in USD, charged since 2025", AS_LANDED),
        ColumnSpec("source_file_path", _TEXT, "Landed file the record was read from", DERIVED),
        ColumnSpec("etl_ingestion_timestamp", TimestampType(), "Instant at which bronze took the record in", DERIVED),
        ColumnSpec("year", _INT, "Calendar year of the pickup; partition column", DERIVED),
        ColumnSpec("month", _INT, "Calendar month of the pickup; partition column", DERIVED),
        ColumnSpec("pickup_hour", _INT, "Hour of day of the pickup, 0 to 23", DERIVED),
        ColumnSpec("vendor_desc", _TEXT, "Vendor code in words", DERIVED),
        ColumnSpec("ratecode_desc", _TEXT, "Rate code in words", DERIVED),
        ColumnSpec("payment_desc", _TEXT, "Payment code in words", DERIVED),
    )
)

# English table descriptions, written to the catalog with each layer.
BRONZE_COMMENT = "Bronze: landed trip records under one type contract, with their source file and ingestion time"
SILVER_COMMENT = "Silver: trip records without repeats and without physically impossible times; every column kept"
GOLD_COMMENT = "Gold: the analytical columns of silver with pickup hour and decoded codes; every silver row kept"

YELLOW_ROLES = Roles("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "total_amount")
YELLOW_TRIPS = TripKind(
    "yellow", TRIP_CONTRACT, YELLOW_ROLES, DEDUP_KEY, GOLD_COLUMNS, (VENDOR_CODES, RATECODES, PAYMENT_CODES)
)

# Green trips have the meter's times under other names, no airport fee and two columns of their own.
# --- fixed values: names of the published green records ---
GREEN_TIMES = {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
# --- end of fixed values ---


def _green(names: Iterable[str]) -> tuple[str, ...]:
    return tuple(GREEN_TIMES.get(n, n) for n in names)


GREEN_CONTRACT = TableContract(
    (
        *[replace(c, name=GREEN_TIMES.get(c.name, c.name)) for c in TRIP_CONTRACT.landed() if c.name != "airport_fee"],
        ColumnSpec("ehail_fee", _DOUBLE, "Fee of an electronic hail in USD", FILLED),
        ColumnSpec("trip_type", _LONG, "Code that tells street hails from dispatched trips", FILLED),
        *[c for c in TRIP_CONTRACT.columns if c.presence == DERIVED],
        ColumnSpec("trip_type_desc", _TEXT, "Trip type in words", DERIVED),
    )
)
GREEN_TRIPS = TripKind(
    "green",
    GREEN_CONTRACT,
    Roles(*_green((YELLOW_ROLES.pickup, YELLOW_ROLES.dropoff)), YELLOW_ROLES.passengers, YELLOW_ROLES.amount),
    _green(DEDUP_KEY),
    (*_green(GOLD_COLUMNS), "trip_type"),
    (*YELLOW_TRIPS.code_maps, TRIP_TYPE_CODES),
)
