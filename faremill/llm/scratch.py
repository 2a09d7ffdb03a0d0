"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only where it is unset and Spark runs locally."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="faremill-llm-"))
    return spark.conf.get("spark.checkpoint.dir")


class Scratch:
    """Written tables of one run. A lost executor costs a re-read, not the steps before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"

    def keep(self, frame: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        """Writes the frame and reads it back; `by`: columns that become folders."""
        path = f"{self.root}/{name}"
        writer = frame.write.option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that no result reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
