"""Ordered sequences of boxes and frames: sampling, filtering and chunking.

A sequence is held flat, one row per box with its position ``idx`` and the
sequence length ``n``, so that a long one spreads over tasks. The nested forms
serve rows that already carry an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import int_div

# Rows of one sequence that share a join group when lengths are looked up.
LENGTH_BLOCK = 65_536


def keeps(idx: Column, n: Column, samples: int) -> Column:
    """Whether position ``idx`` of a sequence of ``n`` is kept by uniform sampling.

    -1 keeps all and 0 none. Otherwise a step of ``n / (samples + 1)`` is
    walked over the whole sequence from a start that centres it, which keeps
    more than ``samples`` positions for most lengths.
    """
    if samples == -1:
        return F.lit(True)
    if samples == 0:
        return F.lit(False)
    step = int_div(n, samples + 1)
    start = int_div(n - (samples - 1) * step, 2)
    return F.when(n <= samples, F.lit(True)).otherwise((idx - start) % step == 0)


def with_length(boxes: DataFrame, keys: Sequence[str], length: str = "n", block: int = LENGTH_BLOCK) -> DataFrame:
    """Add the length of each sequence to its rows; needs ``idx`` 0..n-1.

    The lengths are copied to every block of positions, so the join never
    brings more than ``block`` rows of a sequence together.
    """
    lengths = (
        boxes.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(length))
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), int_div(F.col(length) - 1, block))))
    )
    return boxes.withColumn("_block", int_div(F.col("idx").cast("bigint"), block)).join(
        lengths, [*keys, "_block"]
    ).drop("_block")


def uniform_sample(boxes: DataFrame, samples: int, keys: Sequence[str] = ("entity",), flag: str = "kept") -> DataFrame:
    """Flag the boxes that uniform sampling keeps; adds the length when it is missing."""
    if "n" not in boxes.columns:
        boxes = with_length(boxes, keys)
    return boxes.withColumn(flag, keeps(F.col("idx"), F.col("n"), samples))


def clear_unsampled(boxes: DataFrame, samples: int, keys: Sequence[str] = ("entity",), patch: str = "patch") -> DataFrame:
    """Drop the pixels of the boxes that are not sampled; the boxes stay."""
    flagged = uniform_sample(boxes, samples, keys, flag="_kept")
    return flagged.withColumn(patch, F.when(F.col("_kept"), F.col(patch))).drop("_kept")


def sample_nested(boxes: Column, samples: int) -> Column:
    """Nested form of :func:`clear_unsampled` for an array of boxes in one row."""
    n = F.size(boxes)
    return F.transform(
        boxes, lambda b, i: b.withField("patch", F.when(keeps(i, n, samples), b.getField("patch")))
    )


def kept_samples(boxes: DataFrame, patch: str = "patch") -> DataFrame:
    """Boxes with pixels and an area."""
    return boxes.where(has_sample(patch))


def has_sample(patch: str = "patch") -> Column:
    """Whether a box has pixels and an area."""
    return F.col(patch).isNotNull() & (F.col("w") * F.col("h") != 0)


def kept_nested(boxes: Column) -> Column:
    return F.filter(boxes, lambda b: b.getField("patch").isNotNull())


def non_empty(entities: DataFrame, boxes: str = "boxes") -> DataFrame:
    """Entities whose box array is neither null nor empty."""
    return entities.where(F.size(boxes) > 0)


def first_sample(boxes: DataFrame, keys: Sequence[str] = ("entity",), patch: str = "patch") -> DataFrame:
    """Pixels of the first sampled box of each entity, for its preview."""
    kept = boxes.where(F.col(patch).isNotNull())
    return kept.groupBy(*keys).agg(F.min("idx").alias("idx"), F.min_by(patch, "idx").alias(patch))


def fragment_chunks(
    frames: DataFrame, size: int = 1000, keys: Sequence[str] = ("video",), item: str | None = None
) -> DataFrame:
    """Cut each sequence into fragments of at most ``size`` consecutive frames.

    ``item`` also gathers that column in frame order; a fragment bounds the array.
    """
    chunked = frames.withColumn("fragment", int_div(F.col("idx").cast("bigint"), size))
    out = [
        F.count(F.lit(1)).alias("n_frames"),
        F.min("idx").alias("first_idx"),
        F.max("idx").alias("last_idx"),
    ]
    if item:
        pairs = F.array_sort(F.collect_list(F.struct(F.col("idx"), F.col(item).alias("v"))))
        out.append(F.transform(pairs, lambda p: p.getField("v")).alias(item))
    return chunked.groupBy(*keys, "fragment").agg(*out)
