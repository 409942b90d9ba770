"""Training-data operators.  Nothing else in the library imports this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Bytes of rows that Spark hands a Python worker at once, so that batches of very long texts stay small.
BATCH_BYTES = "4m"
#: Python workers return what a batch used: Spark keeps them for later tasks, and allocators keep freed memory.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
}
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package where it lies (a cluster gets it with --py-files), and bounds their batches and kept memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))
