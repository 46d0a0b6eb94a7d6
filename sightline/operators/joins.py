"""Joins of sighting streams that arrive at different times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.names import to_micros

BUFFER_MS = 600_000
BATCH_MS = 2_000


def batch_of(ts: Column, batch_ms: int = BATCH_MS) -> Column:
    """Number of the micro-batch a row falls in."""
    return F.floor(to_micros(ts) / (batch_ms * 1000)).cast("bigint")


def full_outer_split(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Same-batch full outer join, split into ``both``, ``left`` and ``right``.

    Built from joins that AQE can split when one key is heavy on one side,
    which it cannot do for a full outer join. Non-key columns must differ.
    """
    keys = list(keys)
    outer = left.join(right.withColumn("_right", F.lit(True)), keys, "left_outer")
    matched = F.col("_right").isNotNull()
    return {
        "both": outer.where(matched).drop("_right"),
        "left": outer.where(~matched).select(*left.columns),
        "right": right.join(left.select(*keys).distinct(), keys, "left_anti"),
    }


def full_outer_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The full outer join as one frame with a ``side`` column."""
    keys = list(keys)
    outer = left.join(right.withColumn("_right", F.lit(True)), keys, "left_outer")
    side = F.when(F.col("_right").isNotNull(), F.lit("both")).otherwise(F.lit("left"))
    only_right = right.join(left.select(*keys).distinct(), keys, "left_anti").withColumn("side", F.lit("right"))
    return outer.withColumn("side", side).drop("_right").unionByName(only_right, allowMissingColumns=True)


def buffered_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str = "left_ts",
    right_ts: str = "right_ts",
    buffer_ms: int = BUFFER_MS,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys at most ``buffer_ms`` apart, in either order.

    Time is cut into blocks of one buffer and each right row is copied to its
    neighbour blocks, so that a busy key is spread over time and a left row is
    only compared with rows near it. ``how`` is ``inner`` or ``left_outer``.
    """
    keys = list(keys)
    micros = buffer_ms * 1000
    block = F.floor(to_micros(F.col(right_ts)) / micros).cast("bigint")
    near = right.withColumn("_block", F.explode(F.array(block - 1, block, block + 1)))
    here = left.withColumn("_block", F.floor(to_micros(F.col(left_ts)) / micros).cast("bigint"))
    match = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_block"]]
    close = F.abs(to_micros(F.col(f"l.{left_ts}")) - to_micros(F.col(f"r.{right_ts}"))) <= micros
    joined = here.alias("l").join(near.alias("r"), [*match, close], how)
    extra = [c for c in right.columns if c not in keys]
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in extra])


def _meetings(left: DataFrame, right: DataFrame, keys: Sequence[str], wait: int) -> DataFrame:
    """What happens to the rows of each (key, batch): ``both``, ``left``, ``late`` or ``waits``.

    Decided on one row per key and batch. ``late`` right rows find a left row
    waiting, at most ``wait`` batches old; ``waits`` right rows do not.
    """
    marked = left.select(*keys, "_batch", F.lit(True).alias("_l"), F.lit(False).alias("_r")).unionByName(
        right.select(*keys, "_batch", F.lit(False).alias("_l"), F.lit(True).alias("_r"))
    )
    present = marked.groupBy(*keys, "_batch").agg(F.bool_or("_l").alias("_l"), F.bool_or("_r").alias("_r"))
    before = Window.partitionBy(*keys).orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1)
    last_left = F.max(F.when(~F.col("_r"), F.col("_batch"))).over(before)
    kind = (
        F.when(F.col("_l") & F.col("_r"), "both")
        .when(F.col("_l"), "left")
        .when(F.col("_batch") - last_left <= wait, "late")
        .otherwise("waits")
    )
    return present.select(*keys, "_batch", kind.alias("_kind"))


def consume_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str = "left_ts",
    right_ts: str = "right_ts",
    batch_ms: int = BATCH_MS,
    buffer_ms: int = BUFFER_MS,
) -> DataFrame:
    """Two-sided buffered join with exact batch rules; ``how`` tells how a pair met.

    ``instant``: both rows in one batch; such rows never enter a buffer.
    ``late_right``: a leftover left row waits in the buffer; it is not used up,
    so later right rows pair with it again.
    ``late_left``: a leftover right row that found no waiting left row waits
    itself for later left rows.
    """
    keys = list(keys)
    left = left.withColumn("_batch", batch_of(F.col(left_ts), batch_ms))
    right = right.withColumn("_batch", batch_of(F.col(right_ts), batch_ms))
    # A buffered row is seen by batches that start less than a buffer after its own.
    wait = (buffer_ms - 1) // batch_ms
    kinds = _meetings(left, right, keys, wait)
    a = left.join(kinds, [*keys, "_batch"]).withColumnsRenamed({"_batch": "_lb", "_kind": "_lk"})
    b = right.join(kinds, [*keys, "_batch"]).withColumnsRenamed({"_batch": "_rb", "_kind": "_rk"})
    apart = F.col("_rb") - F.col("_lb")
    waiting = (F.col("_lk") == "left") & F.col("_rk").isin("late", "waits")
    how = (
        F.when((F.col("_lk") == "both") & (apart == 0), "instant")
        .when(waiting & apart.between(1, wait), "late_right")
        .when(waiting & apart.between(-wait, -1) & (F.col("_rk") == "waits"), "late_left")
    )
    pairs = buffered_join(a, b, keys, left_ts, right_ts, buffer_ms + batch_ms)
    return pairs.withColumn("how", how).where(F.col("how").isNotNull()).drop("_lb", "_lk", "_rb", "_rk")


def joined_union(pairs: DataFrame, ready: DataFrame) -> DataFrame:
    """All assembled pairs, with the pairs that arrive ready-made."""
    return pairs.unionByName(ready.withColumn("how", F.lit("ready")), allowMissingColumns=True)


def load_join(boxes: DataFrame, samples: DataFrame, keys: Sequence[str] = ("entity", "idx")) -> DataFrame:
    """Boxes of the header with the pixels of those that were sampled, else null."""
    return boxes.join(samples.select(*keys, "patch"), list(keys), "left_outer")


def valid_edges(links: DataFrame, nodes: DataFrame, order: Sequence[str], node_id: str = "id") -> DataFrame:
    """Directed links whose two ends exist; the last value of a link wins.

    Links are reduced to one per pair first, so the checks see each pair once.
    """
    last = links.groupBy("src", "dst").agg(F.max_by("sim", F.struct(*order)).alias("sim"))
    ids = nodes.select(F.col(node_id).alias("_id")).distinct()
    return last.join(ids, F.col("src") == F.col("_id"), "left_semi").join(
        ids, F.col("dst") == F.col("_id"), "left_semi"
    )


def pid_join(containers: DataFrame, processes: DataFrame, keys: Sequence[str] = ("node", "pid")) -> DataFrame:
    """GPUs and their memory used by each container, as arrays in GPU order.

    Memory is summed per process and GPU first: the arrays are as long as a node has GPUs.
    """
    keys = list(keys)
    per_gpu = processes.groupBy(*keys, "gpu").agg(F.sum("mem").alias("mem"))
    per_pid = per_gpu.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("gpu", "mem"))).alias("_use"))
    use = F.coalesce(F.col("_use"), F.expr("cast(array() as array<struct<gpu:bigint,mem:bigint>>)"))
    return (
        containers.join(per_pid, keys, "left_outer")
        .withColumn("index_list", F.transform(use, lambda u: u.getField("gpu")))
        .withColumn("mem_list", F.transform(use, lambda u: u.getField("mem")))
        .drop("_use")
    )


def drop_stored(
    incoming: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    archived: DataFrame | None = None,
    archive_keys: Sequence[str] = ("task",),
) -> DataFrame:
    """Entities still to be saved: one row per key, not stored and not inside an archive."""
    fresh = incoming.dropDuplicates(list(keys)).join(stored.select(*keys).distinct(), list(keys), "left_anti")
    if archived is not None:
        fresh = fresh.join(archived.select(*archive_keys).distinct(), list(archive_keys), "left_anti")
    return fresh

