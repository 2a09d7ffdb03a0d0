"""Session builder with the few settings the library's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps zoned timestamps (the ingestion instant) independent of the host;
# ANSI makes an impossible cast an error instead of a silent NULL; AQE coalesces
# small shuffle partitions, splits skewed ones and re-plans joins at run time.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str = "faremill",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; `settings` override the defaults above.

    `master` is left to spark-submit unless given. The number of shuffle
    partitions is a property of the cluster and the data, so it is not set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
