"""Packing token sequences into bins: large items are matched, small ones go where they fit best.

Where an item goes depends on its length alone, and there are no more lengths
than a bin has tokens. So the plan is made from the number of items of each
length: bins of equal content are planned together as a group with a count.

1. Items above a third of a bin: at most two fit. From the longest down, each
   is matched with the longest item that still fits beside it, which leaves the
   fewest without a partner.
2. The others, from the longest down, go to the bin with the least room that
   takes them; a new bin is opened when none does.

Spark counts the lengths and numbers the items of each length; the number tells
an item's bin and place.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import BATCH_ROWS, ranked_copies, stored
from sightline.llm.tokens import BYTE_BPE, ByteBpe

CAPACITY = 2048

# The id that ends every document.
END = 0

# Placed rows leave a task in batches of about this many.
OUT_ROWS = 1 << 18


@dataclass(frozen=True)
class Group:
    """``bins`` bins that all hold, for each (length, times), that many items of that length, in this order."""

    bins: int
    items: tuple[tuple[int, int], ...]


def match_large(counts: dict[int, int], capacity: int) -> list[Group]:
    """Bins of items above a third of the capacity: as many pairs as there can be, the rest alone."""
    left = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    alive = sorted(left)
    groups = []
    while alive:
        long = alive[-1]
        at = bisect_right(alive, min(long, capacity - long)) - 1
        if at >= 0 and alive[at] == long and left[long] < 2:
            at -= 1
        if at < 0:
            groups.append(Group(left[long], ((long, 1),)))
            left[long] = 0
        elif alive[at] == long:
            groups.append(Group(left[long] // 2, ((long, 2),)))
            left[long] %= 2
        else:
            short = alive[at]
            n = min(left[long], left[short])
            groups.append(Group(n, ((long, 1), (short, 1))))
            left[long] -= n
            left[short] -= n
            if not left[short]:
                del alive[at]
        if not left[long]:
            alive.pop()
    return groups


def fill_gaps(groups: list[Group], counts: dict[int, int], capacity: int) -> list[Group]:
    """The groups with all items up to a third of the capacity added, each to the fullest bin that takes it."""
    by_gap: dict[int, list[Group]] = defaultdict(list)
    gaps: list[int] = []

    def add(gap: int, group: Group) -> None:
        if group.bins:
            if not by_gap[gap]:
                insort(gaps, gap)
            by_gap[gap].append(group)

    for group in groups:
        add(capacity - sum(n * times for n, times in group.items), group)
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                add(capacity, Group(math.ceil(left / (capacity // length)), ()))
                continue
            gap = gaps[at]
            group = by_gap[gap].pop()
            if not by_gap[gap]:
                del gaps[at]
            fit = gap // length
            full = min(group.bins, left // fit)
            add(gap - fit * length, Group(full, (*group.items, (length, fit))))
            left -= full * fit
            others = group.bins - full
            if others and left:
                add(gap - left * length, Group(1, (*group.items, (length, left))))
                left, others = 0, others - 1
            add(gap, Group(others, group.items))
    return [g for gap in sorted(by_gap) for g in by_gap[gap]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of equal bins that together hold all items, given how many there are of each length."""
    return fill_gaps(match_large(counts, capacity), counts, capacity)


def places(groups: list[Group]) -> np.ndarray:
    """One line per group and length: length, first item, last item, items per bin, first bin, offset; ordered."""
    used: dict[int, int] = defaultdict(int)
    lines, first_bin = [], 0
    for group in groups:
        offset = 0
        for length, times in group.items:
            n = group.bins * times
            lines.append((length, used[length], used[length] + n - 1, times, first_bin, offset))
            used[length] += n
            offset += length * times
        first_bin += group.bins
    return np.array(sorted(lines), dtype="int64").reshape(-1, 6)


def _place(lines: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of items given by length and number within the length."""
    scale = int(lines[:, 2].max()) + 1
    at = np.searchsorted(lines[:, 0] * scale + lines[:, 1], length * scale + rank, side="right") - 1
    _, first, _, times, first_bin, offset = lines[at].T
    return first_bin + (rank - first) // times, offset + (rank - first) % times * length


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``, the place of their ``length`` tokens in that sequence.

    Lengths must lie between 1 and ``capacity``; others, and null, are refused.
    Offsets of a sequence run from 0 without gaps. Numbers are handed out in the
    order of a hash and the column values, so reruns agree; rows equal in every
    column are interchangeable and are counted before they are numbered, so a
    length or row that fills a third of the table is spread over many tasks.
    Only the count of each length reaches the driver, and the plan, which the
    capacity bounds, the tasks. No rows give no rows. Columns named
    ``sequence_id`` or ``offset`` are replaced.
    """
    rows = rows.drop("sequence_id", "offset")
    fits = F.when(F.col("length").between(1, capacity), F.col("length").cast("long"))
    counts = {r[0]: r[1] for r in rows.groupBy(fits.alias("length")).count().collect()}  # at most capacity + 1 rows
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no length from 1 to {capacity}")
    schema = rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    spark, names = rows.sparkSession, rows.columns
    if not counts:
        return spark.createDataFrame([], schema)
    lines = spark.sparkContext.broadcast(places(plan(counts, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column("_n").to_numpy()
            # A batch is cut where its copies would make too many rows.
            cuts = np.flatnonzero(np.diff((np.cumsum(copies) - copies) // OUT_ROWS)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(copies)], strict=True):
                n = copies[low:high]
                row = np.repeat(np.arange(low, high), n)
                before = np.cumsum(n) - n
                rank = batch.column("_first").to_numpy()[row] + np.arange(len(row)) - np.repeat(before, n)
                out = batch.select(names).take(pa.array(row))
                length = out.column("length").to_numpy().astype("int64")
                sequence, offset = _place(lines.value, length, rank)
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
                )

    return ranked_copies(rows, "length", max(counts.values())).mapInArrow(run, schema)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of every document's tokens and the id that ends it.

    Documents over ``capacity`` are cut from their end into pieces of that
    length, so the first piece may be shorter; others are one piece. A null or
    empty text is the end alone. Equal rows give equal pieces. Special tokens
    are not added. ``ids_crc32`` is over the ids as little-endian unsigned
    32-bit numbers; without ``keep_ids`` the ids are left out.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        # Spark bounds a batch by bytes; its tokens are held for a few rows at a time.
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            bpe = bpe or ByteBpe(tokenizer or BYTE_BPE)
            known: dict[str, np.ndarray] = {}
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                if text not in known:
                    known[text] = np.array([*bpe.encode(text), END], dtype="<u4")
                all_ids = known[text]
                first = len(all_ids) % capacity or capacity
                bounds = [0, *range(first, len(all_ids), capacity), len(all_ids)]
                for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    doc.append(row)
                    piece.append(i)
                    start.append(low)
                    length.append(high - low)
                    crc.append(crc32(all_ids[low:high].tobytes()))
                    if keep_ids:
                        ids.append(all_ids[low:high].astype("int32"))
            columns = [
                batch.column("doc_id").take(pa.array(doc, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                *([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, pieces) of packed pieces: the sequence's tokens and where each document lies in it."""
    names = ["offset", "doc_id", "piece", "start", "length"]
    parts = F.sort_array(F.collect_list(F.struct(*names, "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"),
        F.transform("p", lambda p: F.struct(*[p[n].alias(n) for n in names])).alias("pieces"),
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Sequence and offset of every piece of every document; ids are read once and not moved.

    Empty tables give no rows; nulls, repeated rows and very long texts are as
    in :func:`pieces` and :func:`pack`; columns but ``doc_id`` and ``text`` are not read.
    """
    return pack(stored(pieces(docs, capacity, tokenizer, keep_ids=False), "pieces"), capacity)
