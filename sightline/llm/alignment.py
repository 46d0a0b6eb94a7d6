"""Alignment of two tokenizers over the same bytes.

Both sides' tokens cover the same bytes. For the start of every token,
``merge_asof`` finds the other side's token that covers it, per document; the
union of both directions is every pair that overlaps. Offsets where tokens of
both sides end cut the tokens into groups: the smallest runs of both sides that
spell the same bytes. An overlapping pair whose tokens end together is a link,
and the links of all documents are counted by pair of ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import BATCH_ROWS, stored
from sightline.llm.tokens import BYTE_BPE, PIECE_BPE, ByteBpe, PieceBpe, lengths

# Tokens of one side that are aligned at a time; runs are cut where both sides end.
RUN_TOKENS = 1 << 18

# Pairs of ids whose counts travel to the tasks as a table; more are joined by shuffles.
TABLE_ROWS = 4_000_000

TOTALS = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string"


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of an A and a B token that share a byte, as positions in both lists.

    Starts are ascending over the whole list, and the tokens of a document
    cover it from its first start without gaps on both sides.
    """
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(start_b))})
    of_a = pd.merge_asof(a, b, on="start", by="doc")
    of_b = pd.merge_asof(b, a, on="start", by="doc")
    # Pairs that start together were found from both sides.
    once = start_a[of_b["a"].to_numpy()] != start_b
    found_a = np.concatenate([of_a["a"].to_numpy(), of_b["a"].to_numpy()[once]])
    found_b = np.concatenate([of_a["b"].to_numpy(), of_b["b"].to_numpy()[once]])
    return found_a, found_b


def cells(n_ids: int, mark: str) -> np.ndarray:
    """For each id its number and a mark, as text of fixed width."""
    return np.array([f"{i}{mark}" for i in range(n_ids)], dtype="S")


class Aligner:
    """Both tokenizers; ``a`` reads a space and the text, ``b`` adds the space by itself."""

    def __init__(self, a: ByteBpe, b: PieceBpe):
        self.a, self.b = a, b
        self.len_a, self.len_b = lengths(a.bytes), lengths(b.bytes)
        self.scale = len(b.bytes)
        self.inner_a, self.last_a = cells(len(a.bytes), ","), cells(len(a.bytes), "|")
        self.inner_b, self.last_b = cells(len(b.bytes), ","), cells(len(b.bytes), ";")

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides, or none when either side's bytes are not those of the text."""
        none = np.zeros(0, "int64")
        if not text:
            return none, none
        whole = " " + text
        want = whole.encode()
        a, b = self.a.encode(whole), self.b.encode(text)
        if b"".join([self.a.bytes[i] for i in a]) != want or b"".join([self.b.bytes[i] for i in b]) != want:
            return none, none
        return np.array(a, "int64"), np.array(b, "int64")

    def documents(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """The columns of ``TOTALS`` and, per document, its linked pairs of ids with their counts."""
        sides = [self.encode(t) for t in texts]
        n_a, n_b = (np.array([len(s[i]) for s in sides], "int64") for i in (0, 1))
        n_groups, n_links, n_overlaps = (np.zeros(len(texts), "int64") for _ in range(3))
        hashes = [hashlib.sha256() if n else None for n in n_a]
        begun: set[int] = set()
        doc_a, doc_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        keys, counts = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
        if len(doc_a):
            a_ids, b_ids = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
            # All texts one behind the other, so starts ascend and a document's last tokens end together.
            a_end, b_end = np.cumsum(self.len_a[a_ids]), np.cumsum(self.len_b[b_ids])
            a_start, b_start = a_end - self.len_a[a_ids], b_end - self.len_b[b_ids]
            shared = np.intersect1d(a_end, b_end, assume_unique=True)
            until_a, until_b = np.searchsorted(a_end, shared) + 1, np.searchsorted(b_end, shared) + 1
            # Runs of whole groups; nothing overlaps across their bounds.
            cuts = np.flatnonzero(np.diff(until_a // RUN_TOKENS, append=-1))
            low_a = low_b = 0
            for cut in cuts:
                high_a, high_b = int(until_a[cut]), int(until_b[cut])
                sa, sb = slice(low_a, high_a), slice(low_b, high_b)
                low_a, low_b = high_a, high_b
                at_a, at_b = overlaps(doc_a[sa], a_start[sa], doc_b[sb], b_start[sb])
                docs = doc_a[sa][at_a]
                n_overlaps += np.bincount(docs, minlength=len(texts))
                together = a_end[sa][at_a] == b_end[sb][at_b]
                docs = docs[together]
                n_links += np.bincount(docs, minlength=len(texts))
                key, n = np.unique(
                    (docs * len(self.a.bytes) + a_ids[sa][at_a][together]) * self.scale + b_ids[sb][at_b][together],
                    return_counts=True,
                )
                keys.append(key)
                counts.append(n)
                lines = self._lines(a_ids[sa], a_end[sa], b_ids[sb], b_end[sb])
                here = np.unique(doc_a[sa])
                ends = np.searchsorted(doc_a[sa], here, side="right") + np.searchsorted(doc_b[sb], here, side="right")
                for doc, low, high in zip(here.tolist(), [0, *ends], ends, strict=False):
                    # Groups are parted by semicolons, also where a document goes on from the run before.
                    hashes[doc].update(b";" * (doc in begun) + lines[low:high].tobytes().replace(b"\0", b"")[:-1])
                    begun.add(doc)
            n_groups += np.bincount(doc_a[until_a - 1], minlength=len(texts))
        # A long document's runs may hold a pair more than once.
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        doc, pair = np.divmod(key, len(self.a.bytes) * self.scale)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "n_overlaps": n_overlaps,
            "groups_sha256": [h.hexdigest() if h else "" for h in hashes],
            "from": np.searchsorted(doc, np.arange(len(texts) + 1)).astype("int32"),
            "pairs": pair,
            "counts": np.bincount(place, np.concatenate(counts), minlength=len(key)).astype("int64"),
        }

    def _lines(self, a_ids: np.ndarray, a_end: np.ndarray, b_ids: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """The ids of whole groups in order as cells of text: ``a,a|b;a|b,b;``."""
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        last_a, last_b = shared[group_a] == a_end, shared[group_b] == b_end
        until_a = np.flatnonzero(last_a) + 1
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        out = np.zeros(len(a_ids) + len(b_ids), max(self.inner_a.dtype, self.inner_b.dtype))
        out[np.arange(len(a_ids)) + before_b[group_a]] = np.where(last_a, self.last_a[a_ids], self.inner_a[a_ids])
        out[np.arange(len(b_ids)) + until_a[group_b]] = np.where(last_b, self.last_b[b_ids], self.inner_b[b_ids])
        return out


def _list_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))


def aligned(docs: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECE_BPE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, pairs, counts) per document.

    ``pairs`` are the distinct linked ids, ``a * size of B's vocabulary + b``,
    ascending, with their ``counts`` in the document. A text that is null,
    empty, or not spelled by both sides' tokens (a space and the text) has no
    tokens: zeros, an empty digest and no pairs. Strings of special tokens are
    plain text. Repeated rows give repeated rows; a very long text is aligned
    in runs that end where both sides' tokens end.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {TOTALS}, pairs array<long>, counts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        # Spark bounds a batch by bytes; tokens are held for a few rows at a time.
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            aligner = aligner or Aligner(ByteBpe(path_a, special=False), PieceBpe(path_b))
            found = aligner.documents(batch.column("text").to_pylist())
            bounds = found.pop("from")
            lists = [_list_column(found.pop(name), bounds) for name in ("pairs", "counts")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v) for v in found.values()], *lists],
                ["doc_id", *found, "pairs", "counts"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, total, best) of all links: ``best`` where the count is the highest of the pair's B id, ties included."""
    pairs = rows.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    totals = stored(pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total")), "pairs")
    own_b = (F.col("pair") % size_b).alias("b")
    highest = totals.groupBy(own_b).agg(F.max("total").alias("highest"))
    return totals.withColumn("b", own_b).join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def _scored_by_table(rows: DataFrame, table: pd.DataFrame) -> DataFrame:
    """Each document's sums over a table that is small enough to go to every task."""
    table = table.sort_values("pair")
    arrays = [table[c].to_numpy("int64") for c in ("pair", "total", "best")]
    shared = rows.sparkSession.sparkContext.broadcast(arrays)
    names = [c for c in rows.columns if c not in ("pairs", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, total, best = shared.value
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            # The slice's own values, and where each document's begin.
            own = batch.column("counts").flatten().to_numpy()
            at = np.searchsorted(pair, batch.column("pairs").flatten().to_numpy())
            sizes = np.array(batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False), "int64")
            ends = np.cumsum(sizes)
            sums = []
            for weights in (best, total):
                running = np.concatenate([[0], np.cumsum(own * weights[at] if len(at) else own)])
                sums.append(pa.array((running[ends] - running[ends - sizes]).astype("int64")))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, *sums], [*names, "n_best", "count_sum"]
            )

    schema = rows.select(*names, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")).schema
    return rows.mapInArrow(run, schema)


def _scored_by_join(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same sums by equality of pairs, for tables of any size."""
    names = [c for c in rows.columns if c not in ("pairs", "counts")]
    # The digest stands for a document's tokens, so rows equal in these columns have the same links.
    links = rows.dropDuplicates(names).select(*names, F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    found = links.select(*names, F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")).join(table, "pair")
    sums = found.groupBy(*names).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in names]
    zero = [F.coalesce(F.col(f"s.{c}"), F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    both = rows.select(*names).alias("r").join(sums.alias("s"), same, "left")
    return both.select(*[F.col(f"r.{c}") for c in names], *zero)


def align_documents(
    docs: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECE_BPE, table_rows: int = TABLE_ROWS
) -> DataFrame:
    """Per document the totals of :func:`aligned`, ``n_best`` and ``count_sum``.

    ``n_best`` is the number of links whose count over all documents is the
    highest of their B id, ties included; ``count_sum`` adds up the counts of
    all links. The texts are read once: what was found is stored, counted, and
    read again. The counts go to the tasks as a table of at most ``table_rows``
    pairs; more are joined. An empty table gives no rows; columns but
    ``doc_id`` and ``text`` are not read.
    """
    rows = stored(aligned(docs, path_a, path_b), "aligned")
    counts = stored(pair_counts(rows, len(PieceBpe(path_b).bytes)), "pair-counts")
    if counts.count() > table_rows:
        return _scored_by_join(rows, counts)
    return _scored_by_table(rows, counts.toPandas())
