"""Session settings the builders are designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Source attributes are hashed through their text form, which must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on (hash key, capture) may reuse a partitioning on the hash key alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Text keys make rows small on disk and large in memory; keep scan tasks moderate.
    "spark.sql.files.maxPartitionBytes": "128m",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply SETTINGS to a session builder; cluster sizing stays with the caller."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def local_session(cores: int | str = "*", name: str = "ledgerloom", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks, without the web page."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder).getOrCreate()
