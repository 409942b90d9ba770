"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a
shared filesystem path).  Only a local session without that setting gets a
private temporary folder, so nothing machine-local is ever used on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lendfeat") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lendfeat-ckpt-"))
    return sc.getCheckpointDir()


#: Bytecode of a method above which the JVM never compiles it.
COMPILED_BYTES = 8000


def compile_wide_rows(spark: SparkSession) -> None:
    """Fuses no operators into one method that the JVM would only interpret.

    An expression over all status months, or all loan columns, makes such a method; run operator by
    operator, Spark splits it into methods of compilable size.  Rows are the same."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lendfeat/{name}-{uuid.uuid4().hex[:12]}"
