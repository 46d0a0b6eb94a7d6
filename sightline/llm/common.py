"""Helpers shared by the operators: stored tables, small Arrow batches, components of a graph."""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sightline.session import ensure_checkpoint_dir, kept

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Texts may be very long, so few rows travel to a Python worker at a time.
BATCH_ROWS = 256


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    folder = re.sub(r"^file:/(?!/)", "file:///", ensure_checkpoint_dir(spark))
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once to the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows a Python worker holds at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Equal rows are numbered in portions of at most this many, and a group's rows in about so many to a task.
COPIES = 1 << 16
PART_ROWS = 100_000


def ranked_copies(
    rows: DataFrame, group: str, largest: int, copies: int = COPIES, part_rows: int = PART_ROWS, least_parts: int = 64
) -> DataFrame:
    """Distinct rows with ``_n``, how often they appear, and ``_first``, the number of the first of them in its group.

    The ``_n`` rows from ``_first`` on have those numbers; numbers of a group run
    from 0 without gaps. Rows that appear more than ``copies`` times come in
    portions. The order is that of a hash and the column values, so it is the
    same however the rows are partitioned. ``largest`` is the size of the largest
    group; a group is cut by hash, into ``least_parts`` or more, and its parts
    are numbered apart.
    """
    parts = max(least_parts, math.ceil(largest / part_rows))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    same = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_all"))
    last = F.floor((F.col("_all") - 1) / copies)
    same = same.select(*columns, "_all", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_portion"))
    mark = F.xxhash64(*columns, "_portion")
    dealt = same.select(
        *columns,
        "_portion",
        F.least(F.lit(copies), F.col("_all") - F.col("_portion") * copies).cast("long").alias("_n"),
        mark.alias("_mark"),
        F.pmod(mark, F.lit(parts)).cast("int").alias("_part"),
    )
    key = F.col(f"`{group}`")
    in_part = Window.partitionBy(key, "_part").orderBy("_mark", *columns, "_portion")
    inside = F.coalesce(F.sum("_n").over(in_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if parts == 1:
        return dealt.select(*columns, "_n", inside.cast("long").alias("_first"))
    sizes = dealt.groupBy(key.alias("_group"), F.col("_part")).agg(F.sum("_n").alias("_rows"))
    sizes = sizes.select("_group", F.col("_part").alias("_at"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    inner = dealt.withColumn("_inside", inside)
    match = key.eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at"))
    return inner.join(sizes, match).select(*columns, "_n", (F.col("_base") + F.col("_inside")).cast("long").alias("_first"))


def _mark(edges: DataFrame) -> tuple:
    """What two equal sets of edges have in common."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of an undirected graph, as (node, root).

    ``edges`` has columns ``a`` and ``b`` of one type; nulls and loops are left
    out, repeats count once. Nodes without an edge do not appear. Large-star and
    small-star rounds alternate until every node points at its root. A round
    moves each edge once, minima are taken before the shuffle, and a hub's
    edges can be split in the joins because both sides are plain shuffles.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = kept(edges.distinct())
    before, now = None, _mark(edges)
    while now[0] and now != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.distinct())
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")))
        moved = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, now = now, _mark(edges)
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
