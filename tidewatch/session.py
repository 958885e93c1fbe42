"""Session defaults that suit these jobs; a cluster's own settings always win."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark, on at most half of the memory."""
    gigabytes = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") >> 31
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidewatch")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", f"{max(1, min(12, gigabytes))}g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
