"""Exact nearest neighbours that skip blocks of the gallery by their angles to a few pivots."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.ranking import top_per_key
from sightline.operators.similarity import CANDIDATE, _best, _cut, _unit, _vector_bytes

# Probes that are held at a time.
PROBE_BYTES = 8 << 20

# Gallery rows of one block.
BLOCK_ROWS = 1024

# Angles are compared with this much to spare, for rounding of similarities and angles.
SLACK = 1e-4


def choose_pivots(gallery: DataFrame, n: int = 8, sample: int = 1024, seed: int = 7) -> np.ndarray:
    """``n`` directions of the gallery, each as far as can be from those before; from at most ``sample`` rows.

    Any pivots give the same neighbours; good ones only let more blocks be skipped.
    """
    rows = gallery.where(F.col("vec").isNotNull()).select("id", "vec")
    held = rows.orderBy(F.xxhash64(F.lit(seed), "id")).limit(sample).toPandas()
    unit = _unit(held["vec"])
    unit = unit[np.isfinite(unit).all(axis=1)] if len(unit) else unit.reshape(0, 0)
    chosen = list(unit[:1])
    while 0 < len(chosen) < min(n, len(unit)):
        nearest = np.max(unit @ np.array(chosen).T, axis=1)
        chosen.append(unit[int(nearest.argmin())])
    return np.array(chosen)


def with_pivots(gallery: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, vec, angles, home): the angle to every pivot and the nearest one, to be stored with the gallery.

    Rows without a direction match nothing and are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) and len(pivots):
                unit = _unit(batch["vec"])
                good = np.isfinite(unit).all(axis=1)
                angles = np.arccos(np.clip(unit[good] @ pivots.T, -1, 1))
                yield batch[good].assign(angles=list(angles), home=angles.argmin(axis=1) if len(angles) else [])

    rows = gallery.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).select("id", "vec")
    return rows.mapInPandas(run, "id long, vec array<double>, angles array<double>, home int")


def clustered(gallery: DataFrame) -> DataFrame:
    """Rows with pivots in ranges of their nearest pivot and the angle to it, so that blocks lie close together."""
    near = F.array_min("angles")
    ranged = gallery.withColumn("near", near).repartitionByRange("home", "near", "id")
    return ranged.sortWithinPartitions("home", "near", "id").drop("near")


class Search:
    """The best of a block of probes so far; ``compared`` counts the pairs whose similarity was taken."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray, pivots: np.ndarray, k: int, skip_self: bool):
        self.ids, self.unit, self.k, self.skip_self = ids, unit, k, skip_self
        self.angles = np.arccos(np.clip(unit @ pivots.T, -1, 1))
        self.reach = np.full(len(ids), math.inf)
        self.place = pd.Series(np.arange(len(ids)), index=ids)
        self.best: list[pd.DataFrame] = []
        self.compared = 0

    def pass_by(self, ids: np.ndarray, unit: np.ndarray, angles: np.ndarray) -> None:
        """A block of the gallery. Two angles to a pivot differ by no more than the angle between the two."""
        low, high = angles.min(axis=0), angles.max(axis=0)
        apart = np.maximum(low - self.angles, self.angles - high).max(axis=1, initial=0)
        concerned = apart <= self.reach
        if not concerned.any():
            return
        self.compared += int(concerned.sum()) * len(ids)
        found = list(_best(self.ids[concerned], self.unit[concerned], ids, unit, self.k, self.skip_self))
        self.best = [_cut([*self.best, *found], self.k)]
        sims = self.best[0].groupby("probe", sort=False)["sim"].agg(["size", "min"])
        full = sims[sims["size"] >= self.k]["min"]
        self.reach[self.place[full.index].to_numpy()] = np.arccos(np.clip(full.to_numpy(), -1, 1)) + SLACK


def topk_pruned(
    probes: DataFrame,
    indexed: DataFrame,
    pivots: np.ndarray,
    k: int = 10,
    skip_self: bool = True,
    probe_bytes: int = PROBE_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The same rows as ``similarity.topk_similar``, from a gallery made by :func:`with_pivots`: (probe, rank, id, sim).

    A task walks its rows in blocks and compares a block only with the probes
    whose ``k``-th best so far is farther than the block can be near. Probes go
    to the tasks in blocks of a checked size, each a pass over the gallery; only
    ``k`` rows per probe and task are shuffled. Probe ids are distinct.
    """
    spark = probes.sparkSession
    usable = probes.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).select("id", "vec")
    blocks = max(1, math.ceil(_vector_bytes(usable)[0] / probe_bytes))
    found = None
    for block in range(blocks):
        held = usable.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toPandas()
        unit = _unit(held["vec"])
        if len(held):
            good = np.isfinite(unit).all(axis=1)
            held, unit = held[good], unit[good]
        if not len(held) or not len(pivots):
            continue
        shared = spark.sparkContext.broadcast((held["id"].to_numpy("int64"), unit, pivots))
        rows = _searched(indexed, shared, k, skip_self, block_rows)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = spark.createDataFrame([], CANDIDATE)
    return top_per_key(found, ["probe"], [F.desc("sim"), F.asc("id")], k)


def _searched(indexed: DataFrame, shared, k: int, skip_self: bool, block_rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = Search(*shared.value, k, skip_self)
        for batch in batches:
            # A block does not mix the surroundings of two pivots.
            for _, rows in batch.groupby("home", sort=False):
                for low in range(0, len(rows), block_rows):
                    part = rows.iloc[low : low + block_rows]
                    search.pass_by(part["id"].to_numpy("int64"), _unit(part["vec"]), np.stack(part["angles"]))
        yield from search.best

    return indexed.select("id", "vec", "angles", "home").mapInPandas(run, CANDIDATE)
