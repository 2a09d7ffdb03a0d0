"""Landing-zone source: one Parquet file (or directory) per trip type, year and month."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import product

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType, IntegralType, StringType, StructField, StructType

from faremill.contracts import REQUIRED, TableContract, PeriodRange
from faremill.errors import MissingColumnError, NoLandedPeriodsError, SchemaDriftError

# --- fixed value: path of a landed period below the landing root ---
PATH_TEMPLATE = "{kind}/{kind}_tripdata_{year:04d}-{month:02d}.parquet"

SOURCE_COL = "source_file_path"
#: Files whose periods one relation tells apart; the list of them is broadcast, some 5 MB.
FILES_AT_ONCE = 20_000


@dataclass(frozen=True, order=True)
class LandedPeriod:
    kind: str
    year: int
    month: int
    path: str
    # The files to read, where that isn't everything at the path.
    only: tuple[str, ...] = field(default=(), compare=False)
    # The period's files by the names that the reader gives them, once its footers were read.
    files: tuple[str, ...] = field(default=(), compare=False)

    @property
    def paths(self) -> tuple[str, ...]:
        return self.only or (self.path,)

    @property
    def key(self) -> str:
        return f"{self.year:04d}_{self.month:02d}"


@dataclass(frozen=True)
class LandingZone:
    """The periods a pipeline expects, and where each of them lands."""

    root: str
    kinds: Sequence[str]
    years: Sequence[int | str]
    months: Sequence[int | str]
    template: str = PATH_TEMPLATE

    def expected(self) -> list[LandedPeriod]:
        return [
            LandedPeriod(k, int(y), int(m), self._path(k, int(y), int(m)))
            for k, y, m in product(self.kinds, self.years, self.months)
        ]

    def window(self) -> PeriodRange:
        return PeriodRange.of(self.years, self.months)

    def _path(self, kind: str, year: int, month: int) -> str:
        return f"{self.root.rstrip('/')}/{self.template.format(kind=kind, year=year, month=month)}"


def landed_schemas(
    spark: SparkSession, zone: LandingZone, periods: Sequence[LandedPeriod] | None = None
) -> dict[LandedPeriod, StructType]:
    """Schema of every expected period (or of those given) that has landed, all files' footers merged; absent periods are left out.

    Only metadata is read. Files of one period whose types disagree are a `SchemaDriftError`. The reads go out side by side, since each of them waits on the
    object store for one footer.
    """

    def footer(period: LandedPeriod) -> tuple[LandedPeriod, StructType] | None:
        try:
            landed = spark.read.option("mergeSchema", True).parquet(*period.paths)
            return replace(period, files=tuple(landed.inputFiles())), landed.schema
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        except Py4JJavaError as e:
            if "CANNOT_MERGE" in str(e.java_exception):
                raise SchemaDriftError(f"the files of {period.kind} {period.key} disagree about a column's type") from e
            raise

    with ThreadPoolExecutor(max_workers=8) as pool:
        found = list(pool.map(footer, zone.expected() if periods is None else periods))
    return dict(f for f in found if f is not None)


def lossy(landed: DataType, wanted: DataType) -> bool:
    """Whether the cast may change values or lose them: a fraction's type to an integer's."""
    return isinstance(landed, FractionalType) and isinstance(wanted, IntegralType)


def _as(landed: StructField, wanted: DataType) -> Column:
    """The landed column in the wanted type; of a fraction's type, what no integer can hold is NULL."""
    value = F.col(f"`{landed.name}`")
    return value.try_cast(wanted) if lossy(landed.dataType, wanted) else value.cast(wanted)


def conform(df: DataFrame, contract: TableContract, unknown: str = "keep") -> DataFrame:
    """Bring landed columns to the contract's names, types and order in one projection.

    Contract columns that `df` lacks aren't invented here (see `scan_periods`). Columns the
    contract doesn't know follow after the known ones, or are dropped with `unknown="drop"`.
    NaN, infinities and numbers out of range are NULL where the contract wants an integer.
    """
    if unknown not in ("keep", "drop"):
        raise ValueError(f"unknown must be 'keep' or 'drop', not {unknown!r}")
    landed = {f.name.lower(): f for f in df.schema.fields}
    known: list[Column] = []
    for spec in contract.columns:
        f = landed.pop(spec.name.lower(), None)
        if f is None:
            continue
        if not spec.accepts(f.dataType):
            raise SchemaDriftError(
                f"column {f.name} landed as {f.dataType.simpleString()}; "
                f"the contract wants {spec.data_type.simpleString()}"
            )
        known.append(_as(f, spec.data_type).alias(spec.name))
    rest = [F.col(f"`{f.name}`") for f in landed.values()] if unknown == "keep" else []
    return df.select(*known, *rest)


def read_landed(
    spark: SparkSession, schemas: Mapping[LandedPeriod, StructType]
) -> Iterator[tuple[list[LandedPeriod], DataFrame]]:
    """One relation for all landed periods of one schema, so a plan grows with the schemas and not with the periods.

    Periods of more than FILES_AT_ONCE files together are dealt to several relations. A period with folders below its path is read by itself, since
    their names may be columns.
    """
    groups: dict[str, list[LandedPeriod]] = {}
    for period, schema in schemas.items():
        flat = len({f.rpartition("/")[0] for f in period.files}) == 1
        groups.setdefault(schema.json() if flat else f"{period}", []).append(period)
    for periods in groups.values():
        while periods:
            held, some = 0, []
            while periods and (not some or held + len(periods[0].files) <= FILES_AT_ONCE):
                held += len(periods[0].files)
                some.append(periods.pop(0))
            yield some, spark.read.schema(schemas[some[0]]).parquet(*(path for p in some for path in p.paths))


def with_period_path(df: DataFrame, periods: Sequence[LandedPeriod]) -> DataFrame:
    """The landed rows with the path their period was configured to land at.

    Which period a row's file is of is known from the names under which the reader listed the period's files; no path is parsed. A file
    that landed since then has its own name for a path.
    """
    if len(periods) == 1:
        return df.withColumn(SOURCE_COL, F.lit(periods[0].path))
    spark = df.sparkSession
    index = spark.createDataFrame([(f, p.path) for p in periods for f in p.files], "_landed_file string, _landed_path string")
    named = df.withColumn("_landed_file", F.input_file_name()).join(F.broadcast(index), "_landed_file", "left")
    return named.withColumn(SOURCE_COL, F.coalesce("_landed_path", "_landed_file")).drop("_landed_file", "_landed_path")


def scan_periods(
    spark: SparkSession,
    zone: LandingZone,
    contract: TableContract,
    unknown: str = "keep",
    schemas: Mapping[LandedPeriod, StructType] | None = None,
) -> DataFrame:
    """All landed periods under the contract, each with the path it was configured to land at.

    Every schema is cast to the contract before the union, so `double` and `bigint` months meet as `bigint`. Missing columns become NULL.
    Raises when nothing landed, a required column is nowhere, or a drift has no safe cast.
    """
    schemas = landed_schemas(spark, zone) if schemas is None else schemas
    if not schemas:
        raise NoLandedPeriodsError(f"none of {len(zone.expected())} expected periods landed under {zone.root}")
    present = {name.lower() for s in schemas.values() for name in s.fieldNames()}
    lost = [c.name for c in contract.landed() if c.presence == REQUIRED and c.name.lower() not in present]
    if lost:
        raise MissingColumnError(f"no landed file has the required columns {lost}")

    frames = [conform(with_period_path(df, periods), contract, unknown) for periods, df in read_landed(spark, schemas)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    filled = contract.struct().fields
    have = {c.lower() for c in union.columns}
    union = union.withColumns({f.name: F.lit(None).cast(f.dataType) for f in filled if f.name.lower() not in have})
    return _contract_order(union, contract)


def _contract_order(df: DataFrame, contract: TableContract) -> DataFrame:
    have = {c.lower(): c for c in df.columns}
    first = [have.pop(s.name.lower()) for s in contract.columns if s.name.lower() in have]
    return df.select(*[f"`{c}`" for c in [*first, *have.values()]])


def read_enforced(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    """Read files or globs under one declared schema.

    Narrower integers widen and absent columns read as NULL. A file whose type can't widen
    to the declared one fails in Spark; `scan_periods` reads those.
    """
    return spark.read.schema(schema).parquet(*paths)


def scan_declared(spark: SparkSession, zone: LandingZone, schema: StructType) -> DataFrame:
    """All landed periods under one declared schema, also where a type has to narrow.

    Periods are read as their footers say, then cast; columns it lacks are NULL, others are not read.
    Text where another type is declared raises `SchemaDriftError`.
    """
    frames = []
    for periods, df in read_landed(spark, landed_schemas(spark, zone)):
        have = {f.name.lower(): f for f in df.schema.fields}
        columns = []
        for field in schema.fields:
            f = have.get(field.name.lower())
            if f is None:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            elif isinstance(f.dataType, StringType) and not isinstance(field.dataType, StringType):
                raise SchemaDriftError(f"column {f.name} of {periods[0].key} landed as text; declared is {field.dataType.simpleString()}")
            else:
                columns.append(_as(f, field.dataType).alias(field.name))
        frames.append(df.select(*columns))
    if not frames:
        raise NoLandedPeriodsError(f"none of {len(zone.expected())} expected periods landed under {zone.root}")
    return reduce(DataFrame.unionByName, frames)


def period_coverage(spark: SparkSession, zone: LandingZone) -> DataFrame:
    """Every expected period with `landed` and its number of rows (0 when absent).

    No column is read; the rows of periods of one schema are counted together, by file.
    """
    schemas = landed_schemas(spark, zone)
    expected = [(p.kind, p.year, p.month, p in schemas, p.path) for p in zone.expected()]
    listed = spark.createDataFrame(expected, "kind string, year int, month int, landed boolean, path string")
    counted = spark.createDataFrame([], "counted_path string, rows long")
    for periods, df in read_landed(spark, schemas):
        by_path = with_period_path(df.select(), periods).groupBy(F.col(SOURCE_COL).alias("counted_path"))
        counted = counted.unionByName(by_path.agg(F.count("*").alias("rows")))
    rows = F.coalesce("rows", F.lit(0)).alias("rows")
    return listed.join(counted, F.col("path") == F.col("counted_path"), "left").select("kind", "year", "month", "landed", rows)
