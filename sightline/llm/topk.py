"""Exact top-k search by exhaustive term-at-a-time accumulation.

A block of rows is held as postings: for each term (component) the rows in
which it is not zero, with their weights. Every query walks through its own
terms and adds its weight times the postings into a dense array of scores, one
place per row of the block. The best ``k`` are cut out of the array by
partitioning, and the blocks' bests are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import kept

# Rows of a block, and queries whose score arrays are held at a time.
BLOCK_ROWS = 4096
QUERY_ROWS = 64

# Queries travel to the tasks in blocks of this many bytes.
QUERY_BYTES = 8 << 20

RESULT = "query_id long, vec_id long, score long"


def quantized(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, terms): each component x as floor(scale * x).

    Rows without an id or vector, and vectors with a null, infinite or NaN
    component, are left out. An empty vector stays and scores 0.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("terms")
    )


def matrix(rows: list) -> np.ndarray:
    """Rows of terms as one array; shorter rows have no postings in the last terms."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width), dtype="int64")
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def postings(block: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For each term its rows and their weights; a term of all rows needs no list of them."""
    out = []
    for term in block.T:
        rows = np.flatnonzero(term)
        full = len(rows) == len(term)
        out.append((slice(None) if full else rows, np.ascontiguousarray(term if full else term[rows])))
    return out


def accumulate(queries: np.ndarray, lists: list, n_rows: int, kind: str) -> np.ndarray:
    """Scores of some queries against a block, one term after another."""
    scores = np.zeros((len(queries), n_rows), dtype=kind)
    for term in range(min(queries.shape[1], len(lists))):
        rows, weights = lists[term]
        own = np.flatnonzero(queries[:, term])
        if len(own) == 0 or len(weights) == 0:
            continue
        added = np.multiply.outer(queries[own, term].astype(kind), weights.astype(kind, copy=False))
        if isinstance(rows, slice) and len(own) == len(queries):
            scores += added
        elif isinstance(rows, slice):
            scores[own] += added
        else:
            scores[np.ix_(own, rows)] += added
    return scores


def _kind(queries: np.ndarray, block: np.ndarray) -> str:
    """The narrowest type that holds every score; whole numbers of any size where 64 bits may not."""
    if not queries.size or not block.size:
        return "int32"
    largest = [max(abs(int(m.min())), abs(int(m.max()))) for m in (queries, block)]
    most = largest[0] * largest[1] * min(queries.shape[1], block.shape[1])
    return "int32" if most < 2**31 else "int64" if most < 2**63 else "object"


def _select(scores: np.ndarray, query_ids, ids, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the k best of each row of scores, without a query's own row; ties go to smaller ids."""
    allowed = query_ids[:, None] != ids[None, :]
    if scores.shape[1] > k + 1:
        # The query's own row may be among the best, so one more is cut out.
        kth = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, -k - 1]
        allowed &= scores >= kth[:, None]
    row, col = np.nonzero(allowed)
    value = scores[row, col].astype("int64")
    order = np.lexsort((ids[col], -value, row))
    row, col, value = row[order], col[order], value[order]
    top = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[top], col[top], value[top]


def _merge(best: pd.DataFrame | None, found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    rows = pd.concat([*([] if best is None else [best]), *found], ignore_index=True)
    rows = rows.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return rows.groupby("query_id", sort=False).head(k)


def _search(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weights = shared.value
        best = None
        for batch in batches:
            for low in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[low : low + BLOCK_ROWS]
                ids, block = part["vec_id"].to_numpy("int64"), matrix(list(part["terms"]))
                lists, kind, found = postings(block), _kind(weights, block), []
                for at in range(0, len(names), QUERY_ROWS):
                    own = names[at : at + QUERY_ROWS]
                    scores = accumulate(weights[at : at + QUERY_ROWS], lists, len(ids), kind)
                    if kind == "object":
                        scores = np.clip(scores, -(2**63), 2**63 - 1).astype("int64")
                    row, col, value = _select(scores, own, ids, k)
                    found.append(pd.DataFrame({"query_id": own[row], "vec_id": ids[col], "score": value}))
                best = _merge(best, found, k)
        if best is not None:
            yield best

    return rows.mapInPandas(run, RESULT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` rows with the highest inner product for each query row, exactly: (query_id, rank, vec_id, score).

    ``vectors`` is (vec_id, terms), whole numbers; a query is no candidate of
    its own, nor are rows that share its id. Ties go to the smaller id;
    repeated rows count as often as they appear. A score beyond a long is
    the nearest long. Queries are gathered in blocks of a fixed size, each sent to all
    rows, and a task passes on ``k`` rows per query; every block is a pass over
    the rows and nothing but those bests is shuffled.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    queries = vectors.where(is_query)
    cells = queries.agg(F.sum(F.size("terms").cast("long") + 1)).first()[0] or 0
    blocks = max(1, math.ceil(8 * cells / query_bytes))
    found = []
    for block in range(blocks):
        held = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toPandas()
        if len(held):
            # Equal ids with different vectors are queries of their own.
            bests = _ranked(_search(vectors, held["vec_id"].to_numpy("int64"), matrix(list(held["terms"])), k), k)
            found.append(kept(bests) if blocks > 1 else bests)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_vectors(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """For every row whose id ``every`` divides, its best other rows by the inner product of whole components."""
    return top_k(quantized(embeddings), F.col("vec_id") % every == 0, k)
