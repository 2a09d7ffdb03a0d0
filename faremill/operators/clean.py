"""Structural cleaning: ordered de-duplication, time rules, calendar columns and the rule waterfall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from faremill.contracts import DEDUP_KEY, YELLOW_ROLES
from faremill.functions.labels import share

PICKUP, DROPOFF = YELLOW_ROLES.pickup, YELLOW_ROLES.dropoff
INGESTED = "etl_ingestion_timestamp"
SOURCE = "source_file_path"


def survivor_order(
    df: DataFrame, key: Sequence[str] = DEDUP_KEY, tie_break: Sequence[str] | None = None
) -> list[str]:
    """Order that decides which of several rows of one key is the first.

    The oldest ingestion comes first. All rows of one ingest share its timestamp, so the rest
    needs a tie-break: `tie_break`, or else source path and then every remaining column, which
    leaves only fully equal rows undecided.
    """
    if tie_break is None:
        decided = {c.lower() for c in (*key, INGESTED, SOURCE)}
        tie_break = [SOURCE] * (SOURCE in df.columns) + [c for c in df.columns if c.lower() not in decided]
    return [INGESTED, *tie_break]


def _times_first(df: DataFrame, key: Sequence[str]) -> list[str]:
    """The key with its time columns in front, for sorting and grouping.

    A sort compares rows by an eight-byte prefix of the leading column and opens the rows only
    on a tie; a hash aggregate that outgrows its memory sorts as well. Times differ from row to
    row, codes hardly do.
    """
    times = (TimestampType, TimestampNTZType)
    return sorted(key, key=lambda c: not isinstance(df.schema[c].dataType, times))


def _numbered(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*_times_first(df, key)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window))


def first_per_key(
    df: DataFrame, key: Sequence[str] = DEDUP_KEY, order: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of each key; rows with the same NULLs in the key are one group.

    In the `row_number() = 1` form Spark keeps one row per key in every map task before the
    shuffle, so a key that holds a third of the table sends one row per task, not all of them.
    """
    order = survivor_order(df, key) if order is None else order
    return _numbered(df, key, order).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_count(df: DataFrame, key: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """Rows, repeats, rows left after de-duplication, and the repeats' percentage.

    Counting needs no ranks: repeats are rows minus keys, a hash aggregate that combines
    on the map side.
    """
    per_key = df.groupBy(*_times_first(df, key)).agg(F.count("*").alias("_n"))
    totals = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows"))
    repeats = F.col("total_rows") - F.col("unique_rows")
    return totals.select(
        "total_rows",
        repeats.alias("duplicate_rows"),
        "unique_rows",
        share(repeats, F.col("total_rows"), 4).alias("pct_of_total"),
    )


#: Up to here Spark cuts each key to the wanted ranks before the shuffle, and the wanted keys are few enough to broadcast.
EXAMPLES = 900


def duplicate_examples(
    df: DataFrame,
    show: Sequence[str],
    n: int,
    key: Sequence[str] = DEDUP_KEY,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The first `n` repeats by key and rank, with the columns of `show`.

    Every repeated key has at least one repeat, so all of them lie in the first n repeated
    keys, and within a key at ranks 2 to n+1. A hash aggregate finds those keys; being n rows,
    they are broadcast (`EXAMPLES` bounds them), and only their rows are ranked, at most n+1 per key and task.
    """
    if not 0 < n <= EXAMPLES:
        raise ValueError(f"n must be from 1 to {EXAMPLES}")
    order = survivor_order(df, key) if order is None else order
    repeated = df.groupBy(*_times_first(df, key)).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    wanted = repeated.orderBy(*key).limit(n).select(*[F.col(c).alias(f"_first_{c}") for c in key])
    same_key = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in key])
    rows = df.join(F.broadcast(wanted), same_key, "left_semi")
    repeats = _numbered(rows, key, order).filter((F.col("_rn") > 1) & (F.col("_rn") <= n + 1))
    return repeats.select(*key, F.col("_rn").alias("occurrence"), *show).orderBy(*key, "occurrence").limit(n)


def in_time_order(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    """Dropoff not before pickup; a NULL on either side fails the test."""
    return F.col(dropoff) >= F.col(pickup)


def time_travel(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    """Dropoff before pickup."""
    return F.col(dropoff) < F.col(pickup)


def derive_calendar(
    df: DataFrame, pickup: str = PICKUP, parts: Sequence[str] = ("year", "month")
) -> DataFrame:
    """Add the calendar columns named in `parts`: year, month, pickup_hour."""
    known = {"year": F.year, "month": F.month, "pickup_hour": F.hour}
    return df.withColumns({p: known[p](F.col(pickup)) for p in parts})


def cleaning_waterfall(
    df: DataFrame,
    keeps: Mapping[str, Column],
    notes: Mapping[str, Column],
    key: Sequence[str] = DEDUP_KEY,
) -> DataFrame:
    """What each cleaning rule touches, alone and in sequence, as one row per rule.

    Rule 0 is the de-duplication. `keeps` holds the conditions a row must meet to stay, in the
    order they apply; a row fails one that is false or NULL for it. They may use key columns
    only, so that all rows of a key share the verdict. `notes` holds conditions on any column
    that are counted while the row stays. `matched_rows` counts a rule on the whole input,
    `removed_rows` what it removes after the rules before it, `remaining_rows` what is left
    then. Everything comes from one scan and one shuffle by the key.
    """
    fails = [~F.coalesce(cond, F.lit(False)) for cond in keeps.values()]
    df.select(*key).select(*fails)  # analysis fails here when a rule uses a column outside the key

    noted = [F.count_if(cond).alias(f"_noted{i}") for i, cond in enumerate(notes.values())]
    per_key = df.groupBy(*_times_first(df, key)).agg(F.count("*").alias("_n"), *noted)

    def total_of(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    aggs = [total_of(F.col("_n")).alias("_total"), F.count("*").alias("_keys")]
    for i, failed in enumerate(fails):
        earlier = reduce(lambda a, b: a | b, fails[:i], F.lit(False))
        aggs.append(total_of(F.when(failed, F.col("_n"))).alias(f"_failed{i}"))
        aggs.append(F.count_if(failed & ~earlier).alias(f"_removed{i}"))
    aggs += [total_of(F.col(f"_noted{i}")).alias(f"_noted{i}") for i in range(len(notes))]

    total, repeats = F.col("_total"), F.col("_total") - F.col("_keys")
    nothing = F.lit(0).cast("long")
    steps = [("duplicate", repeats, repeats)]
    steps += [(rule, F.col(f"_failed{i}"), F.col(f"_removed{i}")) for i, rule in enumerate(keeps)]
    steps += [(rule, F.col(f"_noted{i}"), nothing) for i, rule in enumerate(notes)]
    rows, left = [], total
    for position, (rule, matched, removed) in enumerate(steps):
        left = left - removed
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(rule).alias("rule"),
                F.lit("removes" if position <= len(keeps) else "keeps").alias("effect"),
                matched.alias("matched_rows"),
                share(matched, total, 4).alias("pct_matched"),
                removed.alias("removed_rows"),
                left.alias("remaining_rows"),
                share(removed, total, 4).alias("pct_removed"),
            )
        )
    return per_key.agg(*aggs).select(F.inline(F.array(*rows)))
