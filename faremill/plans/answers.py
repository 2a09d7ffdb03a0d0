"""The two business answers over gold: revenue by month, and mean passengers by hour of day.

Each function takes any DataFrame with gold's columns; `roles` names those that hold the amount and
the passengers, where a type of record has other names than yellow trips. Over the gold table its filters reach
the partitions (year, month) and the Parquet row groups (amount, passengers), and it reads
two or three columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.contracts import MONTH_LABELS, PERIOD_MEAN_LABEL, YELLOW_ROLES, Roles
from faremill.functions.labels import daypart, hour_label, money_label, month_label
from faremill.functions.text import sql_text
from faremill.functions.money import AMOUNT, exact_avg, exact_sum

# --- fixed values: place of the summary row in the report, and label of the wide table's row ---
SUMMARY_ORDER = 99
WIDE_LABEL = "Média"
# --- end of fixed values ---


def _paid(df: DataFrame, roles: Roles) -> DataFrame:
    """Trips that brought revenue: chargebacks and trips without a charge are out."""
    return df.filter(F.col(roles.column("amount")) > 0)


def revenue_by_month(df: DataFrame, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Trips and revenue by year and month."""
    return (
        _paid(df, roles)
        .groupBy("year", "month")
        .agg(F.count("*").alias("total_trips"), F.round(exact_sum(roles.column("amount")), 2).alias("total_amount_received"))
        .orderBy("year", "month")
    )


def _monthly(df: DataFrame, roles: Roles) -> DataFrame:
    return (
        _paid(df, roles)
        .groupBy("year", "month")
        .agg(exact_sum(roles.column("amount")).alias("total"), exact_avg(roles.column("amount")).alias("avg_ticket"))
    )


def ticket_by_month(df: DataFrame, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Revenue and mean amount per trip by month."""
    return (
        _monthly(df, roles)
        .select(
            "year",
            "month",
            F.round("total", 2).alias("monthly_total"),
            F.round("avg_ticket", 4).alias("avg_trip_amount"),
        )
        .orderBy("year", "month")
    )


def period_means(df: DataFrame, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Mean of the monthly totals and mean of the monthly mean tickets, every month weighing the same."""
    return _monthly(df, roles).agg(
        F.round(F.avg("total"), 2).alias("avg_monthly_total"), F.round(F.avg("avg_ticket"), 4).alias("avg_monthly_ticket")
    )


def revenue_report(df: DataFrame, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Formatted monthly revenue and ticket, with the period's means as the last row."""
    monthly = _monthly(df, roles)
    detail = monthly.select(
        month_label("month").alias("mes"),
        money_label(F.col("total") / 1_000_000, 1, "M").alias("receita_total"),
        money_label(F.col("avg_ticket"), 2).alias("ticket_medio"),
        F.lit(0).alias("sort_group"),
        F.col("year").alias("sort_year"),
        F.col("month").alias("sort_month"),
    )
    summary = monthly.agg(F.avg("total").alias("total"), F.avg("avg_ticket").alias("avg_ticket")).select(
        F.lit(PERIOD_MEAN_LABEL).alias("mes"),
        money_label(F.col("total") / 1_000_000, 1, "M").alias("receita_total"),
        money_label(F.col("avg_ticket"), 2).alias("ticket_medio"),
        F.lit(SUMMARY_ORDER).alias("sort_group"),
        F.lit(None).cast("int").alias("sort_year"),
        F.lit(None).cast("int").alias("sort_month"),
    )
    ordered = detail.unionByName(summary).orderBy("sort_group", "sort_year", "sort_month")
    return ordered.drop("sort_group", "sort_year", "sort_month")


def revenue_report_sql(df: DataFrame, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """`revenue_report` as SQL text, for those who read the gold table in SQL."""
    months = " ".join(f"WHEN {m} THEN {sql_text(text)}" for m, text in MONTH_LABELS.items())
    paid = f"`{roles.column('amount')}`"
    return df.sparkSession.sql(
        f"""
        WITH paid AS (
          SELECT year, month, CAST(sum(amount) AS double) AS revenue, CAST(sum(amount) AS double) / count(amount) AS ticket
          FROM (SELECT year, month, try_cast({paid} AS {AMOUNT}) AS amount FROM {{gold}} WHERE {paid} > 0)
          GROUP BY year, month
        ),
        entries AS (
          SELECT 0 AS block, year, month, CASE month {months} END AS mes, revenue, ticket FROM paid
          UNION ALL
          SELECT {SUMMARY_ORDER}, NULL, NULL, {sql_text(PERIOD_MEAN_LABEL)}, avg(revenue), avg(ticket) FROM paid
        ),
        printed AS (
          SELECT *, '$' || round(revenue / 1000000, 1) || 'M' AS receita_total, '$' || round(ticket, 2) AS ticket_medio
          FROM entries
        )
        SELECT * EXCEPT (block, year, month, revenue, ticket) FROM printed ORDER BY block, year, month
        """,
        gold=df,
    )


def _hourly(df: DataFrame, year: int, month: int, digits: int, roles: Roles) -> DataFrame:
    people = roles.column("passengers")
    return (
        df.filter((F.col("year") == year) & (F.col("month") == month) & (F.col(people) > 0))
        .groupBy("pickup_hour")
        .agg(F.round(F.avg(people), digits).alias("avg_passengers"), F.count("*").alias("total_trips"))
    )


def avg_passengers_by_hour(
    df: DataFrame, year: int, month: int, digits: int = 4, roles: Roles = YELLOW_ROLES
) -> DataFrame:
    """Mean passengers and trips by pickup hour of one month; empty and unknown trips are out."""
    return _hourly(df, year, month, digits, roles).orderBy("pickup_hour")


def hour_extremes(df: DataFrame, year: int, month: int, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Hours with the lowest and the highest mean, taken to two digits; the first hour wins a tie."""
    hour, mean = F.col("pickup_hour"), F.col("avg_passengers")
    return _hourly(df, year, month, 2, roles).agg(
        F.min_by(hour, F.struct(mean, hour)).alias("min_hour"),
        F.min(mean).alias("min_avg"),
        F.max_by(hour, F.struct(mean, -hour)).alias("max_hour"),
        F.max(mean).alias("max_avg"),
    )


def hours_wide(df: DataFrame, year: int, month: int, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """The hourly means as one row with a column per hour; hours without trips are NULL."""
    hourly = _hourly(df, year, month, 2, roles).withColumn("metric", F.lit(WIDE_LABEL))
    means = hourly.groupBy("metric").pivot("pickup_hour", list(range(24))).agg(F.first("avg_passengers"))
    return means.select("metric", *[F.col(str(h)).alias(hour_label(h)) for h in range(24)])


def daypart_profile(df: DataFrame, year: int, month: int, roles: Roles = YELLOW_ROLES) -> DataFrame:
    """Parts of the day with the range of their hourly means."""
    return (
        _hourly(df, year, month, 2, roles)
        .groupBy(daypart(F.col("pickup_hour")).alias("daypart"))
        .agg(
            F.min("pickup_hour").alias("first_hour"),
            F.max("pickup_hour").alias("last_hour"),
            F.min("avg_passengers").alias("min_avg"),
            F.max("avg_passengers").alias("max_avg"),
        )
        .orderBy("first_hour")
    )
