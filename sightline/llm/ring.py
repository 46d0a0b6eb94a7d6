"""Consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into cells of equal size. Every shard owns virtual nodes at the
start of some cells; a key belongs to the first virtual node at or before its
cell. A shard takes no more than its capacity, and what it can't take continues
clockwise to the next virtual nodes of shards with room. All of this needs only
the number of rows in each cell, a table whose size is a parameter, so the
driver lays out ranges of the ring and Spark places the rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import ranked_copies

CELLS = 1 << 14
VIRTUAL_NODES = 128

# Rows of one cell that a task sorts; fuller cells are dealt to several tasks.
CELL_ROWS = 1_000_000


@dataclass(frozen=True)
class Range:
    """Rows ``first``..``last`` of the ring, counted clockwise, go to ``shard`` from ``slot`` on."""

    first: int
    last: int
    shard: int
    slot: int


def virtual_nodes(shards: int, per_shard: int = VIRTUAL_NODES, cells: int = CELLS) -> dict[int, int]:
    """Cell -> shard. A virtual node's cell depends on its shard and number alone; the lower one keeps a taken cell."""
    nodes: dict[int, int] = {}
    for shard in range(shards):
        for number in range(per_shard):
            nodes.setdefault(xxhash.xxh64_intdigest(f"{shard}/{number}") % cells, shard)
    return nodes


def capacities(total: int, shards: int, load_factor: float) -> list[int]:
    """Most rows of each shard: at factor 1 exactly ``total`` together, at most one apart."""
    if load_factor <= 1:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [math.ceil(load_factor * total / shards)] * shards


def lay_out(counts: np.ndarray, shards: int, load_factor: float, per_shard: int = VIRTUAL_NODES) -> list[Range]:
    """Where the rows of each cell go, in clockwise order of the rows.

    First every virtual node keeps as many rows of its own arc as its shard has
    room for; then, clockwise, the rest of each arc moves on to the next
    virtual nodes whose shards have room.
    """
    nodes = virtual_nodes(shards, per_shard, len(counts))
    starts = sorted(nodes)
    owners = [nodes[c] for c in starts]
    before = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    total = int(before[-1])
    room = capacities(total, shards, load_factor)
    used = [0] * shards
    # Rows before the first virtual node belong to the last one, around the ring.
    arcs = [(int(before[c]), int(before[n])) for c, n in zip(starts, [*starts[1:], len(counts)], strict=True)]
    if starts[0] > 0:
        arcs.append((0, int(before[starts[0]])))
        owners.append(owners[-1])
    ranges, waiting = [], []

    def give(shard: int, first: int, last: int) -> int:
        n = min(last - first, room[shard] - used[shard])
        if n > 0:
            ranges.append(Range(first, first + n - 1, shard, used[shard]))
            used[shard] += n
        return first + max(n, 0)

    for place, (first, last) in enumerate(arcs):
        first = give(owners[place], first, last)
        if first < last:
            waiting.append((place, first, last))
    for place, first, last in waiting:
        step = place
        while first < last:
            step += 1
            first = give(owners[step % len(owners)], first, last)
    return sorted(ranges, key=lambda r: r.first)


def _cell(key: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(cells)).cast("int")


def assign(
    rows: DataFrame,
    key: str,
    shards: int,
    load_factor: float = 1.25,
    per_shard: int = VIRTUAL_NODES,
    cells: int = CELLS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the place in the shard, without gaps from 0.

    No shard holds more than ``load_factor`` times the mean, rounded up; with 1
    the shards' sizes differ by one at most. The order within a cell is that of
    a hash and the column values, so it is the same however the rows are
    partitioned; rows equal in every column are interchangeable. A null key has
    a place of its own on the ring. Rows that share a key, however many, are
    ranked by several tasks and overflow like others. An empty table gives no
    rows. Columns named ``shard`` or ``slot`` are replaced.
    """
    rows = rows.drop("shard", "slot")
    spark = rows.sparkSession
    placed = rows.withColumn("_cell", F.coalesce(_cell(F.col(key), cells), F.lit(0)))
    counts = np.zeros(cells, dtype="int64")
    for cell, n in placed.groupBy("_cell").count().collect():  # at most ``cells`` rows
        counts[cell] = n
    parts = max(1, math.ceil(int(counts.max()) / cell_rows))
    # Equal rows are counted before they are numbered, so a key's rows spread over tasks and reruns agree.
    ranked = ranked_copies(placed, "_cell", int(counts.max()), part_rows=cell_rows, least_parts=1)
    last = F.col("_first") + F.col("_n") - 1
    placed = ranked.withColumn("_rank", F.explode(F.sequence(F.col("_first"), last))).drop("_first", "_n")

    ranges = lay_out(counts, shards, load_factor, per_shard)
    starts = [r.first for r in ranges]
    before = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    pieces = []
    for cell in np.nonzero(counts)[0]:
        low, high = int(before[cell]), int(before[cell + 1]) - 1
        at = bisect_right(starts, low) - 1
        while at < len(ranges) and ranges[at].first <= high:
            r = ranges[at]
            pieces.append((int(cell), low, r.first, r.last, r.shard, r.slot))
            at += 1
    # As many rows as cells and ranges together, which the parameters bound.
    layout = spark.createDataFrame(pieces, "_cell int, _low long, _first long, _last long, shard int, _slot long")
    place = F.col("_low") + F.col("_rank")
    found = placed.join(F.broadcast(layout), "_cell").where((place >= F.col("_first")) & (place <= F.col("_last")))
    return found.withColumn("slot", F.col("_slot") + place - F.col("_first")).select(
        *[F.col(f"`{c}`") for c in rows.columns], "shard", "slot"
    )


def shard_documents(docs: DataFrame, shards: int = 16, load_factor: float = 1.0) -> DataFrame:
    """Every document's shard by its id; the texts are read once and not moved."""
    narrow = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return assign(narrow, "doc_id", shards, load_factor).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

