"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot county, customer or part must not become one straggling task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "backlog") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own, sized by its operator."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
