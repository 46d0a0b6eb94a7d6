"""Session settings shared by the library, the tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every operator assumes. Shuffle partitions are left to the
# caller: AQE coalesces them, so a cluster should start high.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the Python line of every column call doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "sightline", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Packed local times carry no zone, so all arithmetic on them is done in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the one the cluster names; only a single local process may make its own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="sightline-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df`` computed once and stored, for results that are dear or must not change."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def kept_in_columns(df: DataFrame) -> DataFrame:
    """Like :func:`kept`, in files that hold numbers in a fraction of the bytes; they stay in the checkpoint folder."""
    folder = re.sub(r"^file:/(?!/)", "file:///", ensure_checkpoint_dir(df.sparkSession))
    path = f"{folder}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
