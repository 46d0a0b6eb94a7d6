"""The entity table on files: every micro-batch adds its updates, readers merge them.

A batch overwrites only its own folder, so a batch that is retried after a
failure leaves the same table, and a batch that fails half way leaves nothing
that a reader sees. Writing costs the size of the batch, not of the table.

``compact`` merges the batches so far into a new version of the base, which
lies in folders by the hash of the key. A version counts once a row names it,
and that row is written last; a stream may go on meanwhile. Readers take the
last version and the batches that came after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sightline.operators.entities import KEYS, PART, merge_groups

# Folders of a base; more let a lookup of few keys read less.
BUCKETS = 256

# Spark passes by folders with such a name when it reads the batches.
_BASE = "_base"
_VERSION = "version long, last_batch long, buckets int"


def write_updates(updates: DataFrame, root: str, batch_id: int) -> None:
    """Store one batch of updates in merge form (keys, group structs, ``seq`` inside the batch)."""
    # How many parts there are is up to the batch.
    updates.drop(PART).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def current_version(spark: SparkSession, root: str) -> Row | None:
    """The last published base: its version, the last batch in it and its number of folders; None before any."""
    try:
        versions = spark.read.schema(_VERSION).parquet(f"{root}/{_BASE}/published")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return versions.orderBy(F.desc("version")).first()


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def base_rows(
    spark: SparkSession, root: str, current: Row, probes: DataFrame | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Rows of a base; with ``probes`` only the folders that may hold their keys are read."""
    rows = spark.read.parquet(f"{root}/{_BASE}/version={current.version}")
    if probes is not None:
        # At most as many numbers as there are folders.
        hit = [r[0] for r in probes.select(_bucket(keys, current.buckets)).distinct().collect()]
        rows = rows.where(F.col("bucket").isin(hit)) if hit else rows.limit(0)
    return rows.drop("bucket").withColumn("batch_id", F.lit(current.last_batch))


def read_updates(
    spark: SparkSession, root: str, schema=None, probes: DataFrame | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Base and later batches, not merged; ``probes`` leaves out folders of other keys."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    batches = reader.parquet(root).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    current = current_version(spark, root)
    if current is None:
        return batches
    later = batches.where(F.col("batch_id") > current.last_batch)
    return later.unionByName(base_rows(spark, root, current, probes, keys), allowMissingColumns=True)


def merge_updates(stored: DataFrame, groups: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Newest value of every column group per entity; later batches win, then later ``seq``."""
    arrival = F.struct(F.col("batch_id").cast("bigint").alias("batch"), F.col("seq").cast("bigint").alias("seq"))
    return merge_groups([stored.withColumn("seq", arrival).drop("batch_id")], groups, keys)


def read_entities(
    spark: SparkSession, root: str, groups: Sequence[str], keys: Sequence[str] = KEYS, schema=None
) -> DataFrame:
    """The entity table over all stored batches, with one struct per column group."""
    return merge_updates(read_updates(spark, root, schema), groups, keys)


def lookup_entities(
    spark: SparkSession, root: str, probes: DataFrame, groups: Sequence[str], keys: Sequence[str] = KEYS, schema=None
) -> DataFrame:
    """The stored entities with the probed keys.

    Of the base only the folders of these keys are read, and all other updates
    go before the shuffle.
    """
    probes = probes.select(*keys).distinct()
    updates = read_updates(spark, root, schema, probes, keys)
    return merge_updates(updates.join(probes, list(keys), "left_semi"), groups, keys)


def read_edges(spark: SparkSession, root: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stored edges from time buckets to entities; an edge that several batches created counts once."""
    return spark.read.parquet(root).drop("batch_id").dropDuplicates(["bucket_start", *keys])


def compact(
    spark: SparkSession,
    root: str,
    groups: Sequence[str],
    keys: Sequence[str] = KEYS,
    buckets: int = BUCKETS,
    files: int = 1,
) -> int | None:
    """Merge the batches so far into a new version of the base; returns it, or None if nothing was new.

    The last batch stays out, as it may still be written; so a stream can go
    on. Each folder has up to ``files`` files, written by as many tasks. One
    compaction runs at a time. Older batches and versions are no longer read,
    and may be deleted once no reader is left that began before.
    """
    stored = read_updates(spark, root)
    current = current_version(spark, root)
    done = current.last_batch if current else -1
    newest = stored.agg(F.max("batch_id")).first()[0]
    if newest is None or newest - 1 <= done:
        return None
    last = stored.where(F.col("batch_id") < newest).agg(F.max("batch_id")).first()[0]
    if last is None or last <= done:
        return None
    merged = merge_updates(stored.where(F.col("batch_id") <= last), groups, keys).withColumn("seq", F.col("seq.seq"))
    merged = merged.withColumn("bucket", _bucket(keys, buckets))
    spread = F.pmod(F.hash(*keys), F.lit(files))
    version = current.version + 1 if current else 0
    dealt = merged.repartition(F.col("bucket"), spread)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{_BASE}/version={version}")
    published = spark.createDataFrame([(version, last, buckets)], _VERSION).coalesce(1)
    published.write.mode("append").parquet(f"{root}/{_BASE}/published")
    return version
