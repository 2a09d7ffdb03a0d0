"""For each registered query, the same result in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from faremill.contracts import GOLD_COLUMNS, TRIP_CONTRACT
from workload.kinds import EVENT_COLUMNS, EVENTS_RESENT, GREEN_COLUMNS, GREEN_IDS
from workload.trips import INGESTED, RECORD_ID, RESENT, TRIP_COLUMNS

KEY = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID"
ORDER = "etl_ingestion_timestamp, l_orderkey, l_partkey, l_suppkey, l_shipdate, l_linenumber"
LO, HI = "TIMESTAMP '1996-01-01 00:00:00'", "TIMESTAMP '1996-06-01 00:00:00'"

IDS = ", ".join((*RECORD_ID, "l_linenumber"))
LANDED = ", ".join(TRIP_COLUMNS)
_MAPPED = ",\n    ".join(f"{text} AS {name}" for name, text in TRIP_COLUMNS.items())

TRIPS = f"""
sent AS (
  SELECT {_MAPPED}, 'batch-1' AS source_file_path, TIMESTAMP '{INGESTED[1]}' AS etl_ingestion_timestamp, {IDS}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
trips AS (
  SELECT * FROM sent
  UNION ALL
  SELECT * REPLACE (-total_amount AS total_amount, 'batch-2' AS source_file_path,
                    TIMESTAMP '{INGESTED[2]}' AS etl_ingestion_timestamp)
  FROM sent WHERE {RESENT}
)"""

NUMBERED = f"{TRIPS},\nnumbered AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER}) AS rn FROM trips)"

SILVER = f"""{NUMBERED},
silver AS (
  SELECT * EXCLUDE (rn),
         CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month
  FROM numbered
  WHERE rn = 1 AND tpep_dropoff_datetime >= tpep_pickup_datetime
    AND tpep_pickup_datetime >= {LO} AND tpep_pickup_datetime < {HI}
)"""

VENDOR = (
    "CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies (CMT)' WHEN 2 THEN 'VeriFone Inc.' "
    "ELSE 'Outro/Inválido: ' || CAST(VendorID AS VARCHAR) END"
)
RATECODE = (
    "CASE RatecodeID WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' "
    "WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' "
    "ELSE 'Outro/Inválido: ' || CAST(RatecodeID AS VARCHAR) END"
)
PAYMENT = (
    "CASE payment_type WHEN 0 THEN 'Flex Fare trip' WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' "
    "WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' "
    "ELSE 'Outro/Inválido: ' || CAST(payment_type AS VARCHAR) END"
)
NUMBERED_PAYMENT = f"CASE WHEN payment_type BETWEEN 0 AND 6 THEN CAST(payment_type AS VARCHAR) || ' - ' ELSE '' END || {PAYMENT}"
MONTH_NAME = (
    "CASE month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Fev' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Abr' WHEN 5 THEN 'Mai' END"
)

GOLD = f"""{SILVER},
gold AS (
  SELECT {", ".join(GOLD_COLUMNS)}, CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
         {VENDOR} AS vendor_desc, {RATECODE} AS ratecode_desc, {PAYMENT} AS payment_desc
  FROM silver
)"""

MONTHLY = f"""{SILVER},
monthly AS (
  SELECT year, month, CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) AS total, CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) / count(CAST(total_amount AS DECIMAL(20,6))) AS avg_ticket
  FROM silver WHERE total_amount > 0 GROUP BY year, month
)"""

HOURLY = f"""{GOLD},
hourly AS (
  SELECT pickup_hour, round(avg(passenger_count), 2) AS avg_passengers
  FROM gold WHERE passenger_count > 0 AND year = 1996 AND month = 5 GROUP BY pickup_hour
)"""

# The landed files: batch 1 by folded month with the drifts, batch 2 whole.
LANDING = f"""{TRIPS},
landing AS (
  SELECT *, CAST((month(tpep_pickup_datetime) - 1) % 5 + 1 AS INT) AS landing_month FROM trips
),
landed AS (
  SELECT * REPLACE (CASE WHEN landing_month = 5 THEN NULL ELSE congestion_surcharge END AS congestion_surcharge,
                    'batch-1/yellow/yellow_tripdata_1996-0' || CAST(landing_month AS VARCHAR) || '.parquet'
                      AS source_file_path),
         CASE WHEN landing_month = 4 THEN trip_distance / 4 END AS cbd_fee
  FROM landing WHERE source_file_path = 'batch-1'
),
landed_again AS (
  SELECT * REPLACE ('batch-2/yellow/yellow_tripdata_1996-05.parquet' AS source_file_path),
         CAST(NULL AS DOUBLE) AS cbd_fee
  FROM landing WHERE source_file_path = 'batch-2'
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"round({part} / {whole} * 100, {digits})"


def _counted(table: str, rules: dict[str, str], digits: int) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INT) AS position, '{name}' AS rule, count(*) FILTER ({cond}) AS matched_rows, "
        f"{_pct(f'count(*) FILTER ({cond})', 'count(*)', digits)} AS pct_of_total FROM {table}"
        for i, (name, cond) in enumerate(rules.items())
    )


def _nulls(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, count(*) - count({c}) AS nulls, "
        f"count(*) AS total FROM {table}"
        for i, c in enumerate(columns)
    )


def _null_profile() -> str:
    columns = [*TRIP_COLUMNS, "source_file_path", "etl_ingestion_timestamp", *RECORD_ID, "l_linenumber"]
    return _with(
        f"{TRIPS},\nnull_counts AS (\n{_nulls('trips', columns)}\n)",
        f"SELECT column_name, nulls, {_pct('nulls', 'total', 4)} AS pct, "
        "CAST((SELECT count(*) FROM null_counts WHERE nulls = 0) AS INT) AS complete_columns "
        "FROM null_counts WHERE nulls > 0",
    )


def _bronze_profile() -> str:
    """Each grouping by a query of its own."""
    nulls = ("passenger_count", "RatecodeID", "store_and_fwd_flag", "congestion_surcharge", "airport_fee")
    counters = {
        "all_null": " AND ".join(f"{c} IS NULL" for c in nulls),
        "zero_passengers": "passenger_count = 0",
        "zero_distance": "trip_distance = 0",
        "negative_total": "total_amount < 0",
        "time_travel": "tpep_dropoff_datetime < tpep_pickup_datetime",
        "out_of_window": f"tpep_pickup_datetime < {LO} OR tpep_pickup_datetime >= {HI}",
        **{f"null_{c}": f"{c} IS NULL" for c in nulls},
    }
    counted = ", ".join(f"count(*) FILTER ({cond}) AS {name}" for name, cond in counters.items())
    rest = f"count(*) AS rows, {counted}, round(min(total_amount), 2) AS min_value, round(max(total_amount), 2) AS max_value FROM trips"
    no_code, no_day = "CAST(NULL AS BIGINT) AS code", "CAST(NULL AS DATE) AS pickup_date"
    parts = [f"SELECT 'all' AS grouping, {no_code}, {no_day}, {rest}"]
    parts += [f"SELECT '{c}' AS grouping, {c} AS code, {no_day}, {rest} GROUP BY {c}" for c in ("VendorID", "RatecodeID", "payment_type")]
    parts.append(f"SELECT 'pickup_date' AS grouping, {no_code}, CAST(tpep_pickup_datetime AS DATE) AS pickup_date, {rest} GROUP BY CAST(tpep_pickup_datetime AS DATE)")
    return _with(TRIPS, "\nUNION ALL\n".join(parts))


def _completeness() -> str:
    columns = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "total_amount"]
    return _with(
        f"{SILVER},\nnull_counts AS (\n{_nulls('silver', columns)}\n)",
        f"SELECT position, column_name, nulls, {_pct('nulls', 'total', 4)} AS pct_null, "
        f"total - nulls AS valid_rows, {_pct('(total - nulls)', 'total', 4)} AS pct_valid FROM null_counts",
    )


def _waterfall() -> str:
    failed_time = "NOT coalesce(tpep_dropoff_datetime >= tpep_pickup_datetime, false)"
    failed_window = f"NOT coalesce(tpep_pickup_datetime >= {LO} AND tpep_pickup_datetime < {HI}, false)"
    steps = [
        ("duplicate", "rn > 1", "rn > 1"),
        ("time_travel", failed_time, f"rn = 1 AND {failed_time}"),
        ("out_of_window", failed_window, f"rn = 1 AND NOT ({failed_time}) AND {failed_window}"),
        (
            "systemic_nulls",
            "passenger_count IS NULL AND RatecodeID IS NULL AND store_and_fwd_flag IS NULL "
            "AND congestion_surcharge IS NULL AND airport_fee IS NULL",
            "false",
        ),
        ("negative_total", "total_amount < 0", "false"),
        ("zero_passengers", "passenger_count = 0", "false"),
        ("zero_distance", "trip_distance = 0", "false"),
    ]
    rows = "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{rule}' AS rule, count(*) AS total, "
        f"count(*) FILTER ({matched}) AS matched_rows, count(*) FILTER ({removed}) AS removed_rows FROM numbered"
        for i, (rule, matched, removed) in enumerate(steps)
    )
    return _with(
        f"{NUMBERED},\nsteps AS (\n{rows}\n)",
        "SELECT CAST(position AS INT) AS position, rule, CASE WHEN position <= 2 THEN 'removes' ELSE 'keeps' END AS effect, "
        f"matched_rows, {_pct('matched_rows', 'total', 4)} AS pct_matched, removed_rows, "
        "CAST(total - sum(removed_rows) OVER (ORDER BY position) AS BIGINT) AS remaining_rows, "
        f"{_pct('removed_rows', 'total', 4)} AS pct_removed FROM steps",
    )


def _distribution(code: str, desc: str, text: str) -> str:
    return _with(
        SILVER,
        f"SELECT {code}, {text} AS {desc}, count(*) AS trips, "
        f"{_pct('count(*)', '(SELECT count(*) FROM silver)', 4)} AS pct_of_total FROM silver GROUP BY {code}",
    )


def _decoded(code: str, desc: str, text: str) -> str:
    return _with(TRIPS, f"SELECT {IDS}, source_file_path, {code}, {text} AS {desc} FROM trips")


def _hours_wide() -> str:
    hours = ", ".join(f"max(avg_passengers) FILTER (pickup_hour = {h}) AS \"{h:02d}h\"" for h in range(24))
    return _with(HOURLY, f"SELECT 'Média' AS metric, {hours} FROM hourly")


def _schema_drift() -> str:
    """Types as the landed files declare them; the counts come from the data."""
    types = dict.fromkeys(TRIP_COLUMNS, ["double"] * 5)
    for c in ("VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID", "payment_type"):
        types[c] = ["bigint"] * 5
    for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        types[c] = ["timestamp_ntz"] * 5
    types["store_and_fwd_flag"] = ["string"] * 5
    absent = "--- AUSENTE ---"
    types["passenger_count"] = ["double", *["bigint"] * 4]
    types["VendorID"] = types["PULocationID"] = ["bigint", "int", *["bigint"] * 3]
    types["airport_fee"] = ["double", "double", absent, "double", "double"]
    types["congestion_surcharge"] = [*["double"] * 4, absent]
    types["Airport_fee"] = [absent, absent, "double", absent, absent]
    types["cbd_fee"] = [*[absent] * 3, "double", absent]
    for c in ("l_orderkey", "l_partkey", "l_suppkey"):
        types[c] = ["bigint"] * 5
    types["l_shipdate"] = ["timestamp_ntz"] * 5
    types["l_linenumber"] = ["int"] * 5
    contract = {"VendorID": "bigint", "PULocationID": "bigint", "passenger_count": "bigint"}

    rows = []
    for name, declared in types.items():
        present = [m for m, t in enumerate(declared, 1) if t != absent]
        retyped = [m for m, t in enumerate(declared, 1) if t not in (absent, contract.get(name, t))]
        months = ", ".join(f"'{t}' AS \"1996_{m:02d}\"" for m, t in enumerate(declared, 1))
        n_types = len(set(declared))

        def filled(which: list[int], name: str = name) -> str:
            return f"count({name}) FILTER (landing_month IN ({', '.join(map(str, which)) or 0}))"

        counts = (filled(present), filled(retyped)) if n_types > 1 else ("CAST(NULL AS BIGINT)",) * 2
        rows.append(
            f"SELECT '{name}' AS column_name, {months}, CAST({n_types} AS INT) AS n_types, "
            f"{str(n_types > 1).lower()} AS drifts, {counts[0]} AS values_present, "
            f"{counts[1]} AS values_retyped, {str(not name.startswith(('l_', 'cbd'))).lower()} AS in_contract "
            + ("FROM landed" if n_types > 1 else "")
        )
    return _with(LANDING, "\nUNION ALL\n".join(rows))


def _cast_losses() -> str:
    """Stated by line number: 5 has a fraction, 6 what no integer can hold, 7 nothing; the resent line 2 has a rate with a fraction."""
    return _with(
        TRIPS,
        "SELECT 'passenger_count' AS column_name, 'yellow' AS kind, '1996_01' AS period, 'double' AS landed_type, "
        "count(*) FILTER (l_linenumber IN (4, 5, 6)) AS values_present, count(*) FILTER (l_linenumber = 6) AS values_lost, "
        "count(*) FILTER (l_linenumber = 5) AS values_cut FROM sent WHERE l_linenumber > 3 HAVING count(*) > 0 "
        "UNION ALL SELECT 'RatecodeID', 'yellow', '1996_02', 'double', count(*), 0, count(*) FROM trips WHERE source_file_path = 'batch-2' HAVING count(*) > 0",
    )


def _faulty_scan() -> str:
    return _with(
        f"""{TRIPS},
faulty AS (
  SELECT l_linenumber, RatecodeID, CASE WHEN source_file_path = 'batch-2' THEN 2 WHEN l_linenumber > 3 THEN 1 ELSE 3 END AS landed_in,
         CASE WHEN source_file_path = 'batch-2' OR l_linenumber <= 4 THEN passenger_count WHEN l_linenumber = 5 THEN 3 END AS passenger_count,
         CASE WHEN source_file_path = 'batch-2' AND l_partkey % 20 = 0 THEN NULL ELSE congestion_surcharge END AS congestion_surcharge
  FROM trips
)""",
        "SELECT 'yellow_tripdata_1996-0' || CAST(landed_in AS VARCHAR) || '.parquet' AS landed_as, count(*) AS row_count, "
        "count(passenger_count) AS n_passenger_count, count(congestion_surcharge) AS n_congestion_surcharge, count(RatecodeID) AS n_RatecodeID, "
        "CAST(sum(passenger_count) AS BIGINT) AS sum_passenger_count, CAST(sum(RatecodeID) AS BIGINT) AS sum_RatecodeID FROM faulty GROUP BY landed_in",
    )


def _month_sizes() -> str:
    columns = len(TRIP_COLUMNS) + 5
    widths = {1: columns, 2: columns, 3: columns, 4: columns + 1, 5: columns - 1}
    cases = " ".join(f"WHEN {m} THEN {w}" for m, w in widths.items())
    return _with(
        LANDING,
        "SELECT '1996_0' || CAST(landing_month AS VARCHAR) AS scope, count(*) AS row_count, "
        f"CAST(CASE landing_month {cases} END AS INT) AS column_count FROM landed GROUP BY landing_month",
    )


def _column_dictionary() -> str:
    types = {
        "VendorID": "bigint",
        "tpep_pickup_datetime": "timestamp_ntz",
        "tpep_dropoff_datetime": "timestamp_ntz",
        "passenger_count": "bigint",
        "total_amount": "double",
        "RatecodeID": "bigint",
        "payment_type": "bigint",
        "year": "int",
        "month": "int",
        "pickup_hour": "int",
        "vendor_desc": "string",
        "ratecode_desc": "string",
        "payment_desc": "string",
    }
    rows = []
    for name, type_name in types.items():
        comment = TRIP_CONTRACT.find(name).comment.replace("'", "''")
        rows.append(
            f"SELECT '{name}' AS column_name, '{type_name}' AS type_name, '{comment}' AS comment, "
            f"count({name}) AS values_present FROM gold"
        )
    return _with(GOLD, "\nUNION ALL\n".join(rows))


_LANDED_COLUMNS = f"{LANDED}, {IDS}, cbd_fee"

ORACLES: dict[str, str] = {
    # answers
    "revenue_by_month": _with(
        SILVER,
        "SELECT year, month, count(*) AS total_trips, round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE), 2) AS total_amount_received "
        "FROM silver WHERE total_amount > 0 GROUP BY year, month ORDER BY year, month",
    ),
    "ticket_by_month": _with(
        MONTHLY,
        "SELECT year, month, round(total, 2) AS monthly_total, round(avg_ticket, 4) AS avg_trip_amount FROM monthly",
    ),
    "period_means": _with(
        MONTHLY,
        "SELECT round(avg(total), 2) AS avg_monthly_total, round(avg(avg_ticket), 4) AS avg_monthly_ticket FROM monthly",
    ),
    "revenue_report": _with(
        MONTHLY,
        f"SELECT {MONTH_NAME} AS mes, '$' || CAST(round(total / 1000000, 1) AS VARCHAR) || 'M' AS receita_total, "
        "'$' || CAST(round(avg_ticket, 2) AS VARCHAR) AS ticket_medio FROM monthly "
        "UNION ALL SELECT 'Média do período', '$' || CAST(round(avg(total) / 1000000, 1) AS VARCHAR) || 'M', "
        "'$' || CAST(round(avg(avg_ticket), 2) AS VARCHAR) FROM monthly",
    ),
    "avg_passengers_by_hour": _with(
        GOLD,
        "SELECT pickup_hour, round(avg(passenger_count), 4) AS avg_passengers, count(*) AS total_trips FROM gold "
        "WHERE passenger_count > 0 AND year = 1996 AND month = 5 GROUP BY pickup_hour ORDER BY pickup_hour",
    ),
    "hour_extremes": _with(
        HOURLY,
        "SELECT (SELECT pickup_hour FROM hourly ORDER BY avg_passengers, pickup_hour LIMIT 1) AS min_hour, "
        "min(avg_passengers) AS min_avg, "
        "(SELECT pickup_hour FROM hourly ORDER BY avg_passengers DESC, pickup_hour LIMIT 1) AS max_hour, "
        "max(avg_passengers) AS max_avg FROM hourly",
    ),
    "hours_wide": _hours_wide(),
    "daypart_profile": _with(
        HOURLY,
        "SELECT CASE WHEN pickup_hour <= 4 THEN 'Madrugada (00–04)' WHEN pickup_hour <= 7 THEN 'Manhã cedo (05–07)' "
        "ELSE 'Dia e tarde (08–23)' END AS daypart, min(pickup_hour) AS first_hour, max(pickup_hour) AS last_hour, "
        "min(avg_passengers) AS min_avg, max(avg_passengers) AS max_avg FROM hourly GROUP BY 1",
    ),
    # cleaning and layers
    "dedup_first": _with(NUMBERED, "SELECT * EXCLUDE (rn) FROM numbered WHERE rn = 1"),
    "duplicate_count": _with(
        NUMBERED,
        "SELECT count(*) AS total_rows, count(*) FILTER (rn > 1) AS duplicate_rows, "
        f"count(*) FILTER (rn = 1) AS unique_rows, {_pct('count(*) FILTER (rn > 1)', 'count(*)', 4)} AS pct_of_total "
        "FROM numbered",
    ),
    "duplicate_examples": _with(
        NUMBERED,
        f"SELECT {KEY}, CAST(rn AS INT) AS occurrence, total_amount, source_file_path, l_orderkey FROM numbered "
        f"WHERE rn > 1 ORDER BY {KEY}, rn LIMIT 5",
    ),
    "preview": _with(
        TRIPS,
        f"SELECT {IDS}, source_file_path, {KEY}, total_amount FROM trips "
        f"ORDER BY {', '.join(RECORD_ID)}, source_file_path LIMIT 10",
    ),
    "filter_time_order": _with(TRIPS, "SELECT * FROM trips WHERE tpep_dropoff_datetime >= tpep_pickup_datetime"),
    "filter_window": _with(
        TRIPS, f"SELECT * FROM trips WHERE tpep_pickup_datetime >= {LO} AND tpep_pickup_datetime < {HI}"
    ),
    "derive_calendar": _with(
        TRIPS,
        f"SELECT {IDS}, source_file_path, tpep_pickup_datetime, CAST(year(tpep_pickup_datetime) AS INT) AS year, "
        "CAST(month(tpep_pickup_datetime) AS INT) AS month, CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour "
        "FROM trips",
    ),
    "cleaning_waterfall": _waterfall(),
    "silver_build": _with(SILVER, "SELECT * FROM silver"),
    "gold_projection": _with(SILVER, f"SELECT {', '.join(GOLD_COLUMNS)} FROM silver"),
    "gold_build": _with(GOLD, "SELECT * FROM gold"),
    # code decoding and labels
    "decode_vendor": _decoded("VendorID", "vendor_desc", VENDOR),
    "decode_ratecode": _decoded("RatecodeID", "ratecode_desc", RATECODE),
    "decode_payment": _decoded("payment_type", "payment_desc", PAYMENT),
    "money_labels": _with(
        TRIPS,
        "SELECT CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month, "
        "'$' || CAST(round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) / 1000000, 1) AS VARCHAR) || 'M' AS total_label, "
        "'$' || CAST(round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) / count(CAST(total_amount AS DECIMAL(20,6))), 2) AS VARCHAR) AS ticket_label FROM trips GROUP BY 1, 2",
    ),
    "month_labels": _with(
        f"{TRIPS},\nby_month AS (SELECT CAST(month(tpep_pickup_datetime) AS INT) AS month, count(*) AS trips "
        "FROM trips GROUP BY 1)",
        f"SELECT month, {MONTH_NAME} AS mes, trips FROM by_month",
    ),
    # bronze profiles
    "null_profile": _null_profile(),
    "null_by_vendor": _with(
        TRIPS,
        f"SELECT VendorID, count(*) AS trips, {_pct('count(*)', '(SELECT count(*) FROM trips)', 4)} AS pct_of_total "
        "FROM trips WHERE passenger_count IS NULL GROUP BY VendorID",
    ),
    "simultaneous_nulls": _with(
        TRIPS,
        "SELECT count(*) AS null_rows, count(*) FILTER (RatecodeID IS NULL AND store_and_fwd_flag IS NULL "
        "AND congestion_surcharge IS NULL AND airport_fee IS NULL) AS all_null_rows "
        "FROM trips WHERE passenger_count IS NULL",
    ),
    "anomaly_counts": _with(
        TRIPS,
        _counted(
            "trips",
            {
                "zero_passengers": "passenger_count = 0",
                "zero_distance": "trip_distance = 0",
                "null_passengers": "passenger_count IS NULL",
                "negative_total": "total_amount < 0",
                "time_travel": "tpep_dropoff_datetime < tpep_pickup_datetime",
                "out_of_window": f"tpep_pickup_datetime < {LO} OR tpep_pickup_datetime >= {HI}",
            },
            4,
        ),
    ),
    "time_travel_profile": _with(
        f"{TRIPS},\nodd AS (SELECT * FROM trips WHERE tpep_dropoff_datetime < tpep_pickup_datetime)",
        f"SELECT VendorID, count(*) AS trips, {_pct('count(*)', '(SELECT count(*) FROM odd)', 2)} AS pct_of_subset "
        "FROM odd GROUP BY VendorID",
    ),
    "negative_total_by_payment": _with(
        f"{TRIPS},\nodd AS (SELECT * FROM trips WHERE total_amount < 0)",
        f"SELECT {NUMBERED_PAYMENT} AS payment_type_desc, count(*) AS trips, "
        f"{_pct('count(*)', '(SELECT count(*) FROM odd)', 2)} AS pct_of_subset FROM odd GROUP BY payment_type",
    ),
    "metric_extremes": _with(
        TRIPS,
        "SELECT round(min(total_amount), 2) AS min_value, round(max(total_amount), 2) AS max_value FROM trips",
    ),
    "out_of_range_profile": _with(
        TRIPS,
        "SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, count(*) AS trips FROM trips "
        f"WHERE tpep_pickup_datetime < {LO} OR tpep_pickup_datetime >= {HI} GROUP BY 1 ORDER BY 1 LIMIT 10",
    ),
    "row_counts": _with(
        GOLD,
        "SELECT 'landed' AS scope, count(*) AS row_count, CAST(19 AS INT) AS column_count FROM trips "
        "UNION ALL SELECT 'silver', count(*), 23 FROM silver UNION ALL SELECT 'gold', count(*), 13 FROM gold",
    ),
    # silver profiles
    "completeness": _completeness(),
    "silver_anomaly_counts": _with(
        SILVER,
        _counted(
            "silver",
            {
                "null_passengers": "passenger_count IS NULL",
                "zero_passengers": "passenger_count = 0",
                "unpaid_total": "total_amount <= 0",
            },
            2,
        ),
    ),
    "filter_interaction": _with(
        SILVER,
        "SELECT count(*) FILTER (passenger_count IS NULL AND total_amount > 0) AS null_count_paid, "
        "count(*) FILTER (passenger_count = 0 AND total_amount > 0) AS zero_count_paid, "
        "count(*) FILTER (total_amount <= 0 AND passenger_count > 0) AS unpaid_with_count FROM silver",
    ),
    "null_code_origin": _with(
        f"{SILVER},\nuncoded AS (SELECT * FROM silver WHERE RatecodeID IS NULL)",
        "SELECT count(*) AS null_code, count(*) FILTER (passenger_count IS NULL) AS with_null_count, "
        "count(*) FILTER (passenger_count = 0) AS with_zero_count, "
        f"{_pct('count(*) FILTER (passenger_count IS NULL)', 'nullif(count(*), 0)', 2)} AS pct_null_count, "
        f"{_pct('count(*) FILTER (passenger_count = 0)', 'nullif(count(*), 0)', 2)} AS pct_zero_count FROM uncoded",
    ),
    "monthly_profile": _with(
        SILVER,
        "SELECT year, month, count(*) AS trips, round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE), 2) AS amount_sum, "
        "round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) / count(CAST(total_amount AS DECIMAL(20,6))), 4) AS amount_avg, round(min(total_amount), 2) AS amount_min, "
        "round(max(total_amount), 2) AS amount_max FROM silver GROUP BY year, month",
    ),
    "monthly_chargebacks": _with(
        SILVER,
        "SELECT year, month, count(*) AS trips, round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE), 2) AS chargeback_amount "
        "FROM silver WHERE total_amount <= 0 GROUP BY year, month",
    ),
    "chargeback_impact": _with(
        f"""{SILVER},
everything AS (SELECT year, month, round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE), 2) AS amount_with_chargebacks FROM silver GROUP BY year, month),
positive AS (SELECT year, month, round(CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE), 2) AS amount_without_chargebacks FROM silver
             WHERE total_amount > 0 GROUP BY year, month)""",
        "SELECT year, month, amount_with_chargebacks, amount_without_chargebacks, "
        "round(amount_without_chargebacks - amount_with_chargebacks, 2) AS difference "
        "FROM everything JOIN positive USING (year, month)",
    ),
    "hourly_profile": _with(
        SILVER,
        "SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, count(*) AS trips, "
        "round(avg(passenger_count), 4) AS avg_passengers, CAST(sum(passenger_count) AS BIGINT) AS passengers "
        "FROM silver WHERE year = 1996 AND month = 5 AND passenger_count > 0 GROUP BY 1",
    ),
    "avg_zero_impact": _with(
        f"{SILVER},\nmay AS (SELECT passenger_count AS p FROM silver WHERE year = 1996 AND month = 5)",
        "SELECT count(*) AS trips, count(*) FILTER (p IS NULL) AS null_rows, count(*) FILTER (p = 0) AS zero_rows, "
        f"count(*) FILTER (p > 0) AS positive_rows, {_pct('count(*) FILTER (p IS NULL)', 'count(*)', 4)} AS pct_null, "
        f"{_pct('count(*) FILTER (p = 0)', 'count(*)', 4)} AS pct_zero, "
        f"{_pct('count(*) FILTER (p > 0)', 'count(*)', 4)} AS pct_positive, "
        "round(avg(p) FILTER (p IS NOT NULL), 2) AS avg_with_zeros, round(avg(p) FILTER (p > 0), 2) AS avg_without_zeros, "
        "round(avg(p) FILTER (p IS NOT NULL) - avg(p) FILTER (p > 0), 2) AS difference FROM may",
    ),
    "vendor_distribution": _distribution("VendorID", "vendor_desc", VENDOR),
    "ratecode_distribution": _distribution("RatecodeID", "ratecode_desc", RATECODE),
    "payment_distribution": _distribution("payment_type", "payment_desc", PAYMENT),
    # landing zone, drift and tables
    "scan_periods": _with(LANDING, f"SELECT {_LANDED_COLUMNS}, source_file_path FROM landed"),
    "month_sizes": _month_sizes(),
    "period_coverage": _with(
        f"{LANDING},\nmonths AS (SELECT CAST(unnest([1, 2, 3, 4, 5, 6]) AS INT) AS month)",
        "SELECT 'yellow' AS kind, CAST(1996 AS INT) AS year, month, month <= 5 AS landed, "
        "(SELECT count(*) FROM landed WHERE landing_month = month) AS rows FROM months",
    ),
    "source_lineage": _with(
        LANDING,
        "SELECT source_file_path AS source_file, count(*) AS trips FROM "
        "(SELECT source_file_path FROM landed UNION ALL SELECT source_file_path FROM landed_again) GROUP BY 1",
    ),
    "schema_enforced_scan": _with(
        LANDING,
        f"SELECT {', '.join(TRIP_COLUMNS)}, l_orderkey, l_partkey, l_suppkey FROM landed",
    ),
    "conflict_columns": _with(
        LANDING,
        "SELECT VendorID, passenger_count, RatecodeID, PULocationID, DOLocationID, l_orderkey, l_partkey, l_suppkey FROM landed",
    ),
    "union_drift": _with(
        LANDING,
        f"SELECT * REPLACE (CAST(passenger_count AS DOUBLE) AS passenger_count) FROM (SELECT {_LANDED_COLUMNS} FROM landed)",
    ),
    "contract_cast": _with(LANDING, f"SELECT {_LANDED_COLUMNS} FROM landed"),
    "schema_drift": _schema_drift(),
    "cast_losses": _cast_losses(),
    "faulty_scan": _faulty_scan(),
    "bronze_build": _with(
        LANDING,
        f"SELECT {_LANDED_COLUMNS}, source_file_path, etl_ingestion_timestamp FROM landed UNION ALL "
        f"SELECT {_LANDED_COLUMNS}, source_file_path, etl_ingestion_timestamp FROM landed_again",
    ),
    "partitioned_roundtrip": _with(GOLD, "SELECT * FROM gold"),
    "column_dictionary": _column_dictionary(),
    "repeated_ingest": _with(
        LANDING,
        "SELECT source_file_path AS source_file, count(*) AS trips, CAST(sum(CAST(total_amount AS DECIMAL(20,6))) AS DOUBLE) AS amount, true AS in_manifest FROM "
        "(SELECT source_file_path, total_amount FROM landed UNION ALL SELECT source_file_path, total_amount FROM landed_again) GROUP BY 1",
    ),
    "bronze_profile": _bronze_profile(),
    "staged_rebuild": _with(SILVER, f"SELECT * EXCLUDE (congestion_surcharge, source_file_path, {IDS}) FROM silver"),
}
ORACLES["chargeback_impact_one_pass"] = ORACLES["chargeback_impact"]
ORACLES["revenue_report_sql"] = ORACLES["revenue_report"]
ORACLES["sink_roundtrip"] = ORACLES["bronze_build"]

# --- other types of record ---


def _sent(columns: dict[str, str], source: str, again: str, amount: str, ids: tuple[str, ...] = ()) -> str:
    """Records of both batches; batch 2 has its own ingestion and the amount negated."""
    mapped = ", ".join([*[f"{text} AS {name}" for name, text in columns.items()], *ids])
    return f"""first_sent AS (SELECT {mapped}, 1 AS batch, {again} AS again FROM {source}),
    sent AS (
      SELECT * EXCLUDE (again) FROM first_sent
      UNION ALL SELECT * EXCLUDE (again) REPLACE (-{amount} AS {amount}, 2 AS batch) FROM first_sent WHERE again
    )"""


GREEN_KEY = "VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, PULocationID, DOLocationID"
GREEN_IN = f"lpep_pickup_datetime >= {LO} AND lpep_pickup_datetime < {HI}"
GREEN_SENT = _sent(GREEN_COLUMNS, "lineitem JOIN orders ON l_orderkey = o_orderkey", RESENT, "total_amount", GREEN_IDS)
GREEN_NUMBERED = f"""{GREEN_SENT},
green_numbered AS (SELECT *, row_number() OVER (PARTITION BY {GREEN_KEY} ORDER BY batch, {", ".join(GREEN_IDS)}) AS rn FROM sent)"""
GREEN_SILVER = f"""{GREEN_NUMBERED},
green AS (
  SELECT {", ".join(GREEN_COLUMNS)}, CAST(year(lpep_pickup_datetime) AS INT) AS year, CAST(month(lpep_pickup_datetime) AS INT) AS month,
         CAST(hour(lpep_pickup_datetime) AS INT) AS pickup_hour
  FROM green_numbered WHERE rn = 1 AND lpep_dropoff_datetime >= lpep_pickup_datetime AND {GREEN_IN}
)"""
TRIP_TYPE = (
    "CASE trip_type WHEN 1 THEN 'Street-hail' WHEN 2 THEN 'Dispatch' ELSE 'Outro/Inválido: ' || CAST(trip_type AS VARCHAR) END"
)
EVENT_SILVER = f"""{_sent(EVENT_COLUMNS, "events", EVENTS_RESENT, "value")},
events_numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY batch, event_id) AS rn FROM sent),
event_gold AS (
  SELECT event_id, ts, user_id, event_type, items, value, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
         CAST(hour(ts) AS INT) AS pickup_hour
  FROM events_numbered WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
)"""


def _green_waterfall() -> str:
    keys = f"""keys AS (
      SELECT {GREEN_KEY}, count(*) AS n, coalesce(lpep_dropoff_datetime >= lpep_pickup_datetime, false) AS in_order,
             coalesce({GREEN_IN}, false) AS inside
      FROM sent GROUP BY {GREEN_KEY}
    ), totals AS (
      SELECT sum(n) AS total, count(*) AS n_keys, sum(n) FILTER (NOT in_order) AS late, count(*) FILTER (NOT in_order) AS gone1,
             sum(n) FILTER (NOT inside) AS beyond, count(*) FILTER (in_order AND NOT inside) AS gone2
      FROM keys
    ), noted AS (SELECT count(*) FILTER (total_amount < 0) AS negative, count(*) FILTER (trip_type IS NULL) AS untyped FROM sent),
    steps AS (
      SELECT 0 AS position, 'duplicate' AS rule, 'removes' AS effect, total - n_keys AS matched, total - n_keys AS removed, total, n_keys AS remaining FROM totals
      UNION ALL SELECT 1, 'time_travel', 'removes', late, gone1, total, n_keys - gone1 FROM totals
      UNION ALL SELECT 2, 'out_of_window', 'removes', beyond, gone2, total, n_keys - gone1 - gone2 FROM totals
      UNION ALL SELECT 3, 'negative_total', 'keeps', negative, 0, total, n_keys - gone1 - gone2 FROM totals, noted
      UNION ALL SELECT 4, 'unknown_type', 'keeps', untyped, 0, total, n_keys - gone1 - gone2 FROM totals, noted
    )"""
    return _with(
        f"{GREEN_SENT}, {keys}",
        "SELECT CAST(position AS INT) AS position, rule, effect, CAST(matched AS BIGINT) AS matched_rows, "
        f"{_pct('matched', 'total', 4)} AS pct_matched, CAST(removed AS BIGINT) AS removed_rows, CAST(remaining AS BIGINT) AS remaining_rows, "
        f"{_pct('removed', 'total', 4)} AS pct_removed FROM steps",
    )


_EXACT = "CAST(sum(CAST({0} AS DECIMAL(20,6))) AS DOUBLE)".format
ORACLES |= {
    "green_silver": _with(GREEN_SILVER, "SELECT * EXCLUDE (pickup_hour) FROM green"),
    "green_gold": _with(
        GREEN_SILVER,
        "SELECT VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, passenger_count, total_amount, RatecodeID, payment_type, year, month, "
        f"trip_type, pickup_hour, {VENDOR} AS vendor_desc, {RATECODE} AS ratecode_desc, {PAYMENT} AS payment_desc, {TRIP_TYPE} AS trip_type_desc FROM green",
    ),
    "green_waterfall": _green_waterfall(),
    "green_revenue_by_month": _with(
        GREEN_SILVER,
        f"SELECT year, month, count(*) AS total_trips, round({_EXACT('total_amount')}, 2) AS total_amount_received FROM green WHERE total_amount > 0 GROUP BY year, month",
    ),
    "green_passengers_by_hour": _with(
        GREEN_SILVER,
        "SELECT pickup_hour, round(avg(passenger_count), 4) AS avg_passengers, count(*) AS total_trips FROM green "
        "WHERE passenger_count > 0 AND year = 1996 AND month = 5 GROUP BY pickup_hour",
    ),
    "green_type_distribution": _with(
        GREEN_SILVER,
        f"SELECT trip_type, {TRIP_TYPE} AS trip_type_desc, count(*) AS trips, {_pct('count(*)', 'sum(count(*)) OVER ()', 4)} AS pct_of_total FROM green GROUP BY trip_type",
    ),
    "events_gold": _with(EVENT_SILVER, "SELECT * FROM event_gold"),
    "events_repeats": _with(
        EVENT_SILVER,
        "SELECT count(*) AS total_rows, count(*) FILTER (rn > 1) AS duplicate_rows, count(*) FILTER (rn = 1) AS unique_rows, "
        f"{_pct('count(*) FILTER (rn > 1)', 'count(*)', 4)} AS pct_of_total FROM events_numbered",
    ),
    "events_value_by_month": _with(
        EVENT_SILVER,
        f"SELECT year, month, count(*) AS total_trips, round({_EXACT('value')}, 2) AS total_amount_received FROM event_gold WHERE value > 0 GROUP BY year, month",
    ),
    "events_ticket_by_month": _with(
        EVENT_SILVER,
        f"SELECT year, month, round({_EXACT('value')}, 2) AS monthly_total, "
        f"round({_EXACT('value')} / count(CAST(value AS DECIMAL(20,6))), 4) AS avg_trip_amount FROM event_gold WHERE value > 0 GROUP BY year, month",
    ),
    "events_items_by_hour": _with(
        EVENT_SILVER,
        "SELECT pickup_hour, round(avg(items), 4) AS avg_passengers, count(*) AS total_trips FROM event_gold "
        "WHERE items > 0 AND year = 2024 AND month = 1 GROUP BY pickup_hour",
    ),
}
