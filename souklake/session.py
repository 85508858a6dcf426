"""Session settings and the shared scratch folder.

Sizes and file operations go through the driver's JVM, so the library needs a classic session, not Spark Connect.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"
SHUFFLE_SETTING = "spark.sql.shuffle.partitions"

# Runtime settings the plans are designed for. Everything else is left to the cluster.
RUNTIME_SETTINGS = {
    # A value that does not parse raises instead of turning into a null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when a later operator of the same stage then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def tuned(spark: SparkSession, *inputs: DataFrame) -> Iterator[SparkSession]:
    """The settings, and shuffles fit for ``inputs``, while a write runs; the session's own come back after."""
    before = {key: spark.conf.get(key, None) for key in (*RUNTIME_SETTINGS, SHUFFLE_SETTING)}
    try:
        tune(spark)
        fit_shuffles(spark, *inputs)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# A shuffle partition should stay well inside one task's memory. Beyond MAX_PARTITIONS (some 8 TB of columnar
# files in one shuffle) the bookkeeping costs more than larger, spilling partitions do; run by month there.
PARTITION_BYTES = 256 * 1024**2
ROW_EXPANSION = 3
MAX_PARTITIONS = 100_000


# What the optimizer says of data whose size it does not know.
UNKNOWN_BYTES = 2**60


def plan_bytes(df: DataFrame) -> int:
    """Size of the columns that a plan reads, by the optimizer's figures for its sources; reads nothing.

    Sources of unknown size, such as rows handed over by the driver, count as nothing. Figures further up in
    a plan are of no use: those of joins are products.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def fit_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Raise the number of shuffle partitions to what the inputs need; never lower it.

    Stored tables count with their file sizes.
    Columnar files unfold to some ROW_EXPANSION times their size as shuffled rows. Adaptive execution
    merges what turns out too small.
    """
    size = sum(plan_bytes(df) for df in inputs)
    wanted = min(size * ROW_EXPANSION // PARTITION_BYTES + 1, MAX_PARTITIONS)
    now = int(spark.conf.get(SHUFFLE_SETTING))
    if wanted > now:
        spark.conf.set(SHUFFLE_SETTING, str(wanted))
    return max(wanted, now)


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the session's ``spark.checkpoint.dir``."""
    root = spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError(f"name a folder that all executors can reach in {SCRATCH_SETTING}")
            # Driver and executors are one process, such as a unit test.
            context.setCheckpointDir(tempfile.mkdtemp(prefix="souklake-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/souklake/{purpose}-{uuid.uuid4().hex}"
