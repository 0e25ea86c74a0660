"""Session settings the reports rely on."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings. Results depend on the time zone only; the rest steers physical planning.
RUNTIME_SETTINGS = {
    # Date-time texts carry no zone; month and day boundaries are read in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The reports keep one consignment partitioning from the join to the roll-up. With this on, a skewed join
    # partition is still split at run time, at the price of one more exchange in that case only.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# At most so much of a shuffle goes to one task where adaptive execution merges partitions. A distinct or a sort holds
# about fifty times these compressed bytes in memory, whatever the size of the input.
ADVISORY_KEY, ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 8 << 20
#: Spark's setting to drop an execution's shuffle files when it ends; for tables that are written and then read from files.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def byte_count(text: str) -> int:
    """Bytes of a size as Spark writes it: 64MB, 8m, 67108864b."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists and return it. A smaller advisory size stays."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if byte_count(spark.conf.get(ADVISORY_KEY)) > ADVISORY_BYTES:
        spark.conf.set(ADVISORY_KEY, f"{ADVISORY_BYTES}b")
    return spark


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, what an execution has shuffled goes with its end, and not when the driver happens to collect garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def local_session(cores: str = "*", app: str = "parcelpay", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Keeping the Python line of every column costs more than the columns themselves.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
