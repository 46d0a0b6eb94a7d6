"""Numbering, top-k and latest-row operators that hold up when one key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import kept

# A window sorts and spills this many rows of one key without trouble; a key
# with more is numbered over many tasks.
HOT_ROWS = 10_000_000

# A key above the limit shows up in the probe about this often.
PROBE_HITS = 10_000


def _probe(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, int]:
    """Keys of a sample of rows, and the count in the sample above which a key is hot."""
    fraction = min(1.0, PROBE_HITS / hot_rows)
    if fraction == 1.0:
        return df.select(*keys), hot_rows
    return df.select(*keys).sample(fraction=fraction, seed=7), PROBE_HITS // 2


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys that hold more than about ``hot_rows`` rows: at most 2 * rows / hot_rows of them.

    Reads only the key columns, and counts a sample of them when the limit is
    high enough for the sample to decide. A wrong guess costs time, never rows.
    None when the whole sample is too small for a hot key, or no key is hot.
    """
    probe, limit = _probe(df, keys, hot_rows)
    # Stops reading as soon as there are enough rows.
    if len(probe.take(limit + 1)) <= limit:
        return None
    # Fixed on disk, so that it is counted once and all who use it see the same keys.
    hot = kept(probe.groupBy(*keys).count().where(F.col("count") > limit).select(*keys))
    return None if hot.isEmpty() else hot


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    index: str = "idx",
    total: str | None = None,
    hot_rows: int = HOT_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key 0..n-1 in ``order``; ``total`` adds n.

    ``probe`` holds the keys of at least the same rows and is cheaper to read
    than ``df``, such as the stored rows that ``df`` is derived from; with it
    ``df`` is computed once. Keys that are hot only there cost time, never rows.

    Rows of one key meet in one task only while the key is small. The rows of a
    hot key are cut into ordered ranges that are numbered apart and shifted by
    the size of the ranges before them.
    """
    hot = hot_keys(df if probe is None else probe, keys, hot_rows)
    if hot is None:
        return _number_small(df, keys, order, index, total)
    # Computed once for both sides of the split and for the bounds of the ranges.
    df = kept(df)
    match = [F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    small = df.alias("d").join(hot.alias("h"), match, "left_anti")
    large = df.alias("d").join(hot.alias("h"), match, "left_semi")
    return _number_small(small, keys, order, index, total).unionByName(
        _number_large(large, keys, order, index, total)
    )


def _number_small(df, keys, order, index, total):
    by_key = Window.partitionBy(*keys)
    out = df.withColumn(index, (F.row_number().over(by_key.orderBy(*order)) - 1).cast("bigint"))
    if total:
        out = out.withColumn(total, F.count(F.lit(1)).over(by_key))
    return out


def _number_large(df, keys, order, index, total):
    part, base = f"_{index}_part", f"_{index}_base"
    # The range bounds come from a sample, so the cut is made once and kept.
    ranged = kept(df.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()))
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys,
        part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias(base),
        *([F.sum("_n").over(by_key).alias(total)] if total else []),
    )
    in_part = Window.partitionBy(*keys, part).orderBy(*order)
    numbered = ranged.withColumn(index, (F.row_number().over(in_part) - 1).cast("bigint"))
    match = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, part]]
    joined = numbered.alias("r").join(offsets.alias("o"), match)
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col(f"r.{index}") + F.col(f"o.{base}")).alias(index),
        *([F.col(f"o.{total}")] if total else []),
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each key. Spark cuts each task's rows to ``k`` per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k).withColumn(
        rank, F.col(rank).cast("bigint")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of each key; partial aggregation keeps one row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def recent_signals(signals: DataFrame, id_col: str = "task", ts_col: str = "ts", size: int = 100) -> DataFrame:
    """The ``size`` ids signalled last, by each id's latest arrival; ties go to the smaller id."""
    latest = signals.groupBy(id_col).agg(F.max(ts_col).alias(ts_col))
    return latest.orderBy(F.desc(ts_col), F.asc(id_col)).limit(size)


def ranked_links(links: DataFrame, hot_rows: int = HOT_ROWS, probe: DataFrame | None = None) -> DataFrame:
    """Out-links of every node, most similar first; ties by target. For ``probe`` see :func:`number_rows`."""
    order = [F.desc("sim"), F.asc("dst")]
    links = links.select("src", "dst", "sim")
    ranked = number_rows(links, ["src"], order, index="rank", hot_rows=hot_rows, probe=probe)
    return ranked.withColumn("rank", F.col("rank") + 1)


def links_of(links: DataFrame, node) -> DataFrame:
    """Out-links of one node, most similar first, sorted over all tasks."""
    return links.where(F.col("src") == node).select("dst", "sim").orderBy(F.desc("sim"), F.asc("dst"))


def link_counts(links: DataFrame) -> DataFrame:
    return links.groupBy("src").agg(F.count(F.lit(1)).alias("n_links"))
