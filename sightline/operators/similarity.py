"""Similarity of entities: exact nearest neighbours and scores of given pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import time_key
from sightline.functions.vectors import dot
from sightline.operators.ranking import top_per_key

# Probes up to this size go to every task; beyond it blocks of them are held while the gallery passes.
BROADCAST_BYTES = 8 << 20

# Size of one block of probes, and of the similarity matrix held at a time.
BLOCK_BYTES = 64 << 20
# Gallery that one task reads past a block of probes.
SLICE_BYTES = 1 << 30
TILE_CELLS = 4_000_000
# Pairs that one task compares.
TASK_CELLS = 1 << 30

# Similarities that agree to this many decimals count as equal.
DECIMALS = 9

CANDIDATE = "probe long, id long, sim double"


def _unit(vectors) -> np.ndarray:
    m = np.array([np.asarray(v, dtype="float64") for v in vectors])
    if m.size:
        with np.errstate(invalid="ignore", divide="ignore"):
            m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m


def _hide_self(sims: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
    rows = np.flatnonzero(np.isin(own, ids))
    if len(rows):
        cols = np.flatnonzero(np.isin(ids, own[rows]))
        row, col = np.nonzero(own[rows][:, None] == ids[cols][None, :])
        sims[rows[row], cols[col]] = -np.inf


def _best(probe_ids, probe_unit, ids, unit, k: int, skip_self: bool, floors=None) -> Iterator[pd.DataFrame]:
    """Top k of a block of rows for every probe, most similar first, ties by id; ``floors`` are the least worth keeping."""
    if len(ids) == 0:
        return
    width = max(1, TILE_CELLS // len(ids))
    for lo in range(0, len(probe_ids), width):
        own = probe_ids[lo : lo + width]
        sims = probe_unit[lo : lo + width] @ unit.T
        if skip_self:
            _hide_self(sims, own, ids)
        floor = None if floors is None else floors[lo : lo + width, None]
        if floor is not None and np.isfinite(floor).all():
            # Only what may reach the floor once rounded is rounded.
            row, col = np.nonzero(sims >= floor - 2 * 10.0**-DECIMALS)
            value = np.round(sims[row, col], DECIMALS)
            reach = value >= floor[row, 0]
            row, col, value = row[reach], col[reach], value[reach]
        else:
            sims = np.round(sims, DECIMALS)
            sims[np.isnan(sims)] = -np.inf
            if len(ids) > k:
                kth = -np.partition(-sims, k - 1, axis=1)[:, k - 1 : k]
                row, col = np.nonzero((sims >= kth) & (sims > -np.inf))
            else:
                row, col = np.nonzero(sims > -np.inf)
            value = sims[row, col]
        order = np.lexsort((ids[col], -value, row))
        row, col, value = row[order], col[order], value[order]
        first = np.searchsorted(row, row, side="left")
        top = np.arange(len(row)) - first < k
        yield pd.DataFrame({"probe": own[row[top]], "id": ids[col[top]], "sim": value[top]})


def _floors(probe_ids, best: pd.DataFrame, k: int) -> np.ndarray:
    """The k-th best so far of every probe; no floor while there are fewer."""
    floors = np.full(len(probe_ids), -np.inf)
    known, starts, counts = np.unique(best["probe"].to_numpy(), return_index=True, return_counts=True)
    known, last = known[counts >= k], starts[counts >= k] + k - 1
    if len(known):
        at = np.minimum(np.searchsorted(known, probe_ids), len(known) - 1)
        hit = known[at] == probe_ids
        floors[hit] = best["sim"].to_numpy()[last[at[hit]]]
    return floors


def _better(best: pd.DataFrame | None, probe_ids, probe_unit, rows: pd.DataFrame, k: int, skip_self: bool) -> pd.DataFrame:
    """The k best of each probe after more rows of the gallery."""
    floors = None if best is None else _floors(probe_ids, best, k)
    found = _best(probe_ids, probe_unit, rows["id"].to_numpy("int64"), _unit(rows["vec"]), k, skip_self, floors)
    return _cut([*([] if best is None else [best]), *found], k)


def _cut(found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The k best of several candidate lists for each probe."""
    if not found:
        return pd.DataFrame({"probe": np.empty(0, "int64"), "id": np.empty(0, "int64"), "sim": np.empty(0)})
    rows = pd.concat(found).sort_values(["probe", "sim", "id"], ascending=[True, False, True])
    return rows.groupby("probe", sort=False).head(k)


def topk_similar(
    probes: DataFrame,
    gallery: DataFrame,
    k: int = 10,
    skip_self: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    slice_bytes: int = SLICE_BYTES,
    task_cells: int = TASK_CELLS,
) -> DataFrame:
    """The ``k`` rows of ``gallery`` most similar to each probe, exactly; both are (id, vec).

    Few probes travel to the gallery's tasks, which need no shuffle. Many are
    cut into blocks that are held one at a time, while a slice of the gallery
    streams past: the gallery is copied once per block, the probes only once
    per slice. Either way a task compares about ``task_cells`` pairs, however
    large both sides are: more rows make more tasks. It multiplies matrices and
    passes on ``k`` rows per probe, never the pairs. Vectors without a
    direction match nothing.
    """
    size, n_probes = _vector_bytes(probes)
    held, n_gallery = _vector_bytes(gallery)
    if size <= broadcast_bytes:
        found = _topk_broadcast(probes, gallery, k, skip_self, math.ceil(n_probes * n_gallery / task_cells))
    else:
        side = math.isqrt(task_cells)
        n_p = max(1, math.ceil(size / block_bytes), math.ceil(n_probes / side))
        n_s = max(1, math.ceil(held / slice_bytes), math.ceil(n_gallery / side))
        found = _topk_blocks(probes, gallery, k, skip_self, n_p, n_s)
    return top_per_key(found, ["probe"], [F.desc("sim"), F.asc("id")], k)


def _vector_bytes(vectors: DataFrame) -> tuple[int, int]:
    """Bytes of all vectors as doubles, and their number."""
    size, n = vectors.agg(F.sum(F.size("vec").cast("bigint")) * 8, F.count(F.lit(1))).first()
    return size or 0, n


def _topk_broadcast(probes, gallery, k, skip_self, tasks):
    held = probes.select("id", "vec").toPandas()
    shared = probes.sparkSession.sparkContext.broadcast(
        (held["id"].to_numpy("int64"), _unit(held["vec"]))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probe_ids, probe_unit = shared.value
        best = None
        for batch in batches:
            best = _better(best, probe_ids, probe_unit, batch, k, skip_self)
        if best is not None:
            yield best

    rows = gallery.select("id", "vec")
    return (rows.repartition(tasks) if tasks > 1 else rows).mapInPandas(run, CANDIDATE)


def _topk_blocks(probes, gallery, k, skip_self, n_p, n_s):
    """Every block of probes with every slice of the gallery; a slice streams past the block and is never held."""
    own = F.xxhash64("id", "vec")

    def dealt(df: DataFrame, side: int, block, part) -> DataFrame:
        at = (F.col("_block") * n_s + F.col("_slice")).cast("long")
        rows = df.select("id", "vec", block.alias("_block"), part.alias("_slice"))
        return rows.select(at.alias("_at"), F.lit(side).alias("_side"), "id", "vec")

    def each(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    held = dealt(probes, 0, F.pmod(own, F.lit(n_p)), each(n_s))
    passing = dealt(gallery, 1, each(n_p), F.pmod(own, F.lit(n_s)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, block, ready, best = None, [], None, None
        for batch in batches:
            for place, rows in batch.groupby("_at"):
                if place != at:
                    if best is not None:
                        yield best
                    at, block, ready, best = place, [], None, None
                first = rows["_side"] == 0
                if first.any():
                    block.append(rows[first])
                rows = rows[~first]
                if block and len(rows):
                    whole = pd.concat(block)
                    ready, block = (whole["id"].to_numpy("int64"), _unit(whole["vec"])), []
                if ready and len(rows):
                    best = _better(best, *ready, rows, k, skip_self)
        if best is not None:
            yield best

    # Every group is a task of its own, and probes come before the gallery in it.
    met = held.unionByName(passing).repartitionById(n_p * n_s, F.col("_at").cast("int"))
    rows = met.sortWithinPartitions("_at", "_side")
    return rows.mapInPandas(run, CANDIDATE)


def rank_lists(top: DataFrame) -> DataFrame:
    """Ranked rows -> one array of ids per probe, best first; as long as ``k``."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "id")))
    return top.groupBy("probe").agg(F.transform(listed, lambda r: r.getField("id")).alias("ids"))


def _with_ends(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Pairs with the columns of both ends, as ``_a_...`` and ``_b_...``."""
    for end, mark in (("src", "_a_"), ("dst", "_b_")):
        side = rows.select(F.col("id").alias(end), *[F.col(c).alias(mark + c) for c in columns])
        pairs = pairs.join(side, end)
    return pairs


def _without_ends(pairs: DataFrame) -> DataFrame:
    return pairs.drop(*[c for c in pairs.columns if c.startswith(("_a_", "_b_"))])


def pair_similarity(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Cosine similarity of given pairs of features, and 1 minus it as dissimilarity.

    Lengths are taken once per feature, not once per pair.
    """
    rows = features.select("id", "vec", F.sqrt(dot(F.col("vec"), F.col("vec"))).alias("len"))
    scored = _with_ends(pairs, rows, "vec", "len").withColumn(
        "similarity", dot(F.col("_a_vec"), F.col("_b_vec")) / (F.col("_a_len") * F.col("_b_len"))
    )
    return _without_ends(scored.withColumn("dissimilarity", 1.0 - F.col("similarity")))


def attr_distance(pairs: DataFrame, scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean absolute difference of the attribute scores of given pairs, over plain columns."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}"))
    return _without_ends(_with_ends(pairs, scores, *columns).withColumn("distance", total / len(columns)))


def sim_by_bucket(pairs: DataFrame, times: DataFrame) -> DataFrame:
    """Given links whose two ends start in one minute or one hour, by ``level``.

    Reads the links that exist instead of pairing up the members of a bucket.
    """
    linked = _with_ends(pairs, times, "start_time")
    same_minute, same_hour = (
        time_key(F.col("_a_start_time"), level) == time_key(F.col("_b_start_time"), level)
        for level in ("minute", "hour")
    )
    level = F.when(same_minute, F.lit("minute")).when(same_hour, F.lit("hour"))
    return _without_ends(linked.withColumn("level", level).where(F.col("level").isNotNull()))
