"""Session settings the library is written for.

On a cluster the session comes from the platform; ``local_session`` is for
tests, the bench and trying things out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Runtime re-planning: joins turn to broadcast once their real size is known,
    # skewed join partitions are split, small shuffle partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Time windows start at the same instants everywhere.
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stratalake")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
