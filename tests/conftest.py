from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from faremill import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

TRIP_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "PULocationID bigint, DOLocationID bigint, passenger_count bigint, total_amount double, "
    "RatecodeID bigint, payment_type bigint, source_file_path string, etl_ingestion_timestamp timestamp_ntz"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "faremill-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_trips(spark: SparkSession) -> Callable[..., DataFrame]:
    """Trips from (field=value) rows; fields left out take a plain trip's values."""
    from datetime import datetime

    names = [part.split()[0] for part in TRIP_SCHEMA.split(", ")]
    plain = dict(
        VendorID=1,
        tpep_pickup_datetime=datetime(2023, 1, 10, 8),
        tpep_dropoff_datetime=datetime(2023, 1, 10, 9),
        PULocationID=10,
        DOLocationID=20,
        passenger_count=1,
        total_amount=10.0,
        RatecodeID=1,
        payment_type=1,
        source_file_path="a.parquet",
        etl_ingestion_timestamp=datetime(2023, 6, 1),
    )

    def make(rows: Sequence[dict]) -> DataFrame:
        data = [tuple({**plain, **r}[n] for n in names) for r in rows]
        return spark.createDataFrame(data, TRIP_SCHEMA)

    return make


def plan_of(df: DataFrame) -> str:
    """Physical plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed_nodes(df: DataFrame) -> list[tuple[str, object]]:
    """Class name and node of everything the plan ran, subqueries included; run `df` first.

    A reused exchange is one node: what it reuses is listed where it ran.
    """
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        found.append((name, node))
        for seq in (node.children(), node.subqueries()):
            stack += [seq.apply(i) for i in range(seq.size())]
    return found


@pytest.fixture
def sf_dir() -> str:
    return SF_DIR
