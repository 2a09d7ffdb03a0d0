"""Data-quality profiles. Each one reads its table once and only the columns it needs.

A profile of many counters is one aggregate of `count_if`s whose single result row is then
turned into rows; a profile by group aggregates on the map side and takes its denominator
from the same shuffled groups, so no second pass over the table is made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contracts import ANSWER_FIELDS, SECONDARY_FIELDS, CodeMap
from faremill.functions.labels import decode, share
from faremill.functions.money import exact_avg, exact_sum


def table_size(df: DataFrame, scope: str) -> DataFrame:
    """Row count and number of columns, labelled with `scope`."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(scope).alias("scope"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def _null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULLs of each column in `_n0`, `_n1`, … and the number of rows in `_total`."""
    total = F.count("*")
    nulls = [(total - F.count(F.col(f"`{c}`"))).alias(f"_n{i}") for i, c in enumerate(columns)]
    return df.agg(total.alias("_total"), *nulls)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that have NULLs, most first, with percentage and the number of columns without any."""
    columns = df.columns if columns is None else columns
    complete = reduce(lambda a, b: a + b, [(F.col(f"_n{i}") == 0).cast("int") for i in range(len(columns))])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    return (
        _null_counts(df, columns)
        .select("_total", complete.alias("complete_columns"), F.inline(entries))
        .filter(F.col("nulls") > 0)
        .select("column_name", "nulls", share(F.col("nulls"), F.col("_total"), 4).alias("pct"), "complete_columns")
        .orderBy(F.desc("nulls"), "column_name")
    )


def completeness(df: DataFrame, columns: Sequence[str] = ANSWER_FIELDS) -> DataFrame:
    """NULL and valid rows of each column in `columns`, in that order."""
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"))
            for i, c in enumerate(columns)
        ]
    )
    valid = F.col("_total") - F.col("nulls")
    return (
        _null_counts(df, columns)
        .select("_total", F.inline(entries))
        .select(
            "position",
            "column_name",
            "nulls",
            share(F.col("nulls"), F.col("_total"), 4).alias("pct_null"),
            valid.alias("valid_rows"),
            share(valid, F.col("_total"), 4).alias("pct_valid"),
        )
    )


def simultaneous_nulls(df: DataFrame, columns: Sequence[str] = SECONDARY_FIELDS) -> DataFrame:
    """Rows where the first column is NULL, and rows where all of them are."""
    nulls = [F.col(c).isNull() for c in columns]
    return df.agg(
        F.count_if(nulls[0]).alias("null_rows"),
        F.count_if(reduce(lambda a, b: a & b, nulls)).alias("all_null_rows"),
    )


def anomaly_counts(df: DataFrame, rules: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """Rows that match each named condition, with percentage of all rows; one pass for all."""
    counters = [F.count_if(cond).alias(f"_c{i}") for i, cond in enumerate(rules.values())]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("rule"), F.col(f"_c{i}").alias("matched_rows"))
            for i, name in enumerate(rules)
        ]
    )
    return (
        df.agg(F.count("*").alias("_total"), *counters)
        .select("_total", F.inline(entries))
        .select(
            "position",
            "rule",
            "matched_rows",
            share(F.col("matched_rows"), F.col("_total"), digits).alias("pct_of_total"),
        )
    )


def group_share(
    df: DataFrame,
    by: Mapping[str, Column],
    among: Column | None = None,
    of: str = "total",
    digits: int = 4,
) -> DataFrame:
    """Rows per group with their percentage of all rows (`of="total"`) or of the matching ones.

    Only rows that satisfy `among` are counted. For the share of the subset the condition is a
    filter that reaches the scan; for the share of the total it is a conditional count, so the
    denominator comes from the same pass. The denominator is a scalar subquery over the same
    groups, whose shuffle Spark reuses.
    """
    if of not in ("total", "subset"):
        raise ValueError(f"of must be 'total' or 'subset', not {of!r}")
    if among is None or of == "subset":
        rows = df if among is None else df.filter(among)
        groups = rows.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.count("*").alias("trips"))
        whole = groups.agg(F.sum("trips")).scalar()
    else:
        groups = df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(
            F.count_if(among).alias("trips"), F.count("*").alias("_all")
        )
        # Both sides use both counters, so that their shuffle is one: no group has fewer than 0 or more than all of its rows.
        whole = groups.agg(F.when(F.min("trips") >= 0, F.sum("_all"))).scalar()
        groups = groups.filter(F.col("trips").between(1, F.col("_all")))
    return groups.select(*by, "trips", share(F.col("trips"), whole, digits).alias(f"pct_of_{of}"))


def code_distribution(df: DataFrame, codes: CodeMap, digits: int = 4) -> DataFrame:
    """Trips per code and description; NULL is a group of its own."""
    by_code = group_share(df, {codes.code_col: F.col(codes.code_col)}, digits=digits)
    return by_code.select(codes.code_col, decode(codes).alias(codes.desc_col), "trips", "pct_of_total").orderBy(
        codes.code_col
    )


def metric_extremes(df: DataFrame, metric: str = "total_amount", digits: int = 2) -> DataFrame:
    return df.agg(
        F.round(F.min(metric), digits).alias("min_value"), F.round(F.max(metric), digits).alias("max_value")
    )


def daily_counts(df: DataFrame, ts: str, n: int | None = None) -> DataFrame:
    """Rows per day, in order; with `n` the earliest days only."""
    days = (
        df.groupBy(F.col(ts).cast("date").alias("pickup_date"))
        .agg(F.count("*").alias("trips"))
        .orderBy("pickup_date")
    )
    return days if n is None else days.limit(n)


def filter_interaction(df: DataFrame, metric: str = "total_amount", count_col: str = "passenger_count") -> DataFrame:
    """How a filter on one metric would cut into the valid rows of the other."""
    amount, people = F.col(metric), F.col(count_col)
    return df.agg(
        F.count_if(people.isNull() & (amount > 0)).alias("null_count_paid"),
        F.count_if((people == 0) & (amount > 0)).alias("zero_count_paid"),
        F.count_if((amount <= 0) & (people > 0)).alias("unpaid_with_count"),
    )


def null_code_origin(df: DataFrame, code: str = "RatecodeID", count_col: str = "passenger_count") -> DataFrame:
    """Whether rows without a code are the ones without a count; NULL percentages when there are none."""
    absent, people = F.col(code).isNull(), F.col(count_col)
    counts = df.agg(
        F.count_if(absent).alias("null_code"),
        F.count_if(absent & people.isNull()).alias("with_null_count"),
        F.count_if(absent & (people == 0)).alias("with_zero_count"),
    )
    return counts.select(
        "*",
        share(F.col("with_null_count"), F.col("null_code"), 2).alias("pct_null_count"),
        share(F.col("with_zero_count"), F.col("null_code"), 2).alias("pct_zero_count"),
    )


def monthly_profile(df: DataFrame, metric: str = "total_amount") -> DataFrame:
    return (
        df.groupBy("year", "month")
        .agg(
            F.count("*").alias("trips"),
            F.round(exact_sum(metric), 2).alias("amount_sum"),
            F.round(exact_avg(metric), 4).alias("amount_avg"),
            F.round(F.min(metric), 2).alias("amount_min"),
            F.round(F.max(metric), 2).alias("amount_max"),
        )
        .orderBy("year", "month")
    )


def monthly_chargebacks(df: DataFrame, metric: str = "total_amount") -> DataFrame:
    """Rows with a metric of zero or less, and their sum, by month."""
    return (
        df.filter(F.col(metric) <= 0)
        .groupBy("year", "month")
        .agg(F.count("*").alias("trips"), F.round(exact_sum(metric), 2).alias("chargeback_amount"))
        .orderBy("year", "month")
    )


def _with_difference(df: DataFrame) -> DataFrame:
    difference = F.round(F.col("amount_without_chargebacks") - F.col("amount_with_chargebacks"), 2)
    return df.withColumn("difference", difference).orderBy("year", "month")


def chargeback_impact(df: DataFrame, metric: str = "total_amount") -> DataFrame:
    """Monthly sum with and without non-positive rows, as the inner join of two aggregates.

    A month without positive rows isn't in the result.
    """
    month = ["year", "month"]
    everything = df.groupBy(*month).agg(F.round(exact_sum(metric), 2).alias("amount_with_chargebacks"))
    positive = (
        df.filter(F.col(metric) > 0)
        .groupBy(*month)
        .agg(F.round(exact_sum(metric), 2).alias("amount_without_chargebacks"))
    )
    return _with_difference(everything.join(positive, month, "inner"))


def chargeback_impact_one_pass(df: DataFrame, metric: str = "total_amount") -> DataFrame:
    """`chargeback_impact` from one scan: the positive part is a conditional sum."""
    amount = F.col(metric)
    sums = df.groupBy("year", "month").agg(
        F.round(exact_sum(amount), 2).alias("amount_with_chargebacks"),
        F.round(exact_sum(F.when(amount > 0, amount)), 2).alias("amount_without_chargebacks"),
    )
    return _with_difference(sums.filter(F.col("amount_without_chargebacks").isNotNull()))


def hourly_profile(
    df: DataFrame, year: int, month: int, count_col: str = "passenger_count", hour: Column | None = None
) -> DataFrame:
    """Trips, mean and sum of a positive count by pickup hour of one month."""
    hour = F.hour("tpep_pickup_datetime") if hour is None else hour
    return (
        df.filter((F.col("year") == year) & (F.col("month") == month) & (F.col(count_col) > 0))
        .groupBy(hour.alias("pickup_hour"))
        .agg(
            F.count("*").alias("trips"),
            F.round(F.avg(count_col), 4).alias("avg_passengers"),
            F.sum(count_col).alias("passengers"),
        )
        .orderBy("pickup_hour")
    )


def avg_zero_impact(df: DataFrame, year: int, month: int, count_col: str = "passenger_count") -> DataFrame:
    """One month's NULL, zero and positive rows, and the mean of the count with and without zeros."""
    people = F.col(count_col)
    parts = df.filter((F.col("year") == year) & (F.col("month") == month)).agg(
        F.count("*").alias("trips"),
        F.count_if(people.isNull()).alias("null_rows"),
        F.count_if(people == 0).alias("zero_rows"),
        F.count_if(people > 0).alias("positive_rows"),
        F.avg(people).alias("_with"),
        F.avg(F.when(people > 0, people)).alias("_without"),
    )
    return parts.select(
        "trips",
        "null_rows",
        "zero_rows",
        "positive_rows",
        *[share(F.col(f"{k}_rows"), F.col("trips"), 4).alias(f"pct_{k}") for k in ("null", "zero", "positive")],
        F.round("_with", 2).alias("avg_with_zeros"),
        F.round("_without", 2).alias("avg_without_zeros"),
        F.round(F.col("_with") - F.col("_without"), 2).alias("difference"),
    )


def grouped_profile(
    df: DataFrame,
    rules: Mapping[str, Column],
    codes: Sequence[str] = ("VendorID", "RatecodeID", "payment_type"),
    ts: str = "tpep_pickup_datetime",
    metric: str = "total_amount",
) -> DataFrame:
    """Every counter of the single profiles, for all rows, by each code and by day, from one scan.

    One row for each group of each grouping set: `grouping` names the set, `code` and `pickup_date` the group. Rows, the rows that match
    each rule, the NULLs of the secondary fields and the extremes of the metric are columns. Shares by any denominator follow from these rows.
    """
    day = "_day"
    needed = df.withColumn(day, F.col(ts).cast("date"))
    sets = [[], [F.col(day)], *([F.col(c)] for c in codes)]
    # The rules read columns that the sets null out, so they are evaluated below the expansion, under names of their own.
    flags = {f"_flag_{i}": cond for i, cond in enumerate([*rules.values(), *(F.col(c).isNull() for c in SECONDARY_FIELDS)])}
    names = ["rows", *rules, *(f"null_{c}" for c in SECONDARY_FIELDS)]
    counters = [F.count("*").alias("rows"), *(F.count_if(F.col(flag)).alias(name) for flag, name in zip(flags, names[1:]))]
    slim = needed.select(day, *codes, F.col(metric).alias("_metric"), *(cond.alias(flag) for flag, cond in flags.items()))
    extremes = [F.round(F.min("_metric"), 2).alias("min_value"), F.round(F.max("_metric"), 2).alias("max_value")]
    in_set = {c: F.grouping(c).alias(f"_out_{c}") for c in (day, *codes)}
    found = slim.groupingSets(sets, F.col(day), *(F.col(c) for c in codes)).agg(*counters, *extremes, *in_set.values())
    grouping = reduce(lambda rest, c: F.when(F.col(f"_out_{c}") == 0, F.lit(c)).otherwise(rest), codes, F.when(F.col(f"_out_{day}") == 0, F.lit("pickup_date")).otherwise(F.lit("all")))
    return found.select(grouping.alias("grouping"), F.coalesce(*codes).alias("code"), F.col(day).alias("pickup_date"), *names, "min_value", "max_value")
