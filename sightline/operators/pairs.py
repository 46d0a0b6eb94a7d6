"""The most similar members of one bucket, without pairing up everything."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import int_div
from sightline.operators.ranking import HOT_ROWS, number_rows
from sightline.operators.similarity import TILE_CELLS, _best, _cut, _unit
from sightline.session import kept

# Members of a bucket that one task holds while the others pass.
STRIP_ROWS = 8192

# Angles are compared with this much to spare, for rounding of similarities and angles.
SLACK = 1e-4


def mean_direction(rows: DataFrame) -> np.ndarray:
    """Direction of the sum of all unit vectors; as long as a vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0.0
        for batch in batches:
            unit = _unit(batch["vec"])
            total = total + unit[np.isfinite(unit).all(axis=1)].sum(axis=0)
        if np.ndim(total):
            yield pd.DataFrame({"place": np.arange(len(total)), "value": total})

    found = rows.select("vec").mapInPandas(run, "place int, value double").groupBy("place").agg(F.sum("value"))
    total = np.array([v for _, v in sorted(map(tuple, found.collect()))])
    size = np.sqrt((total * total).sum())
    return total / size if size else total


def _with_angles(rows: DataFrame, pivot: np.ndarray) -> DataFrame:
    """(bucket, id, vec, angle): each vector's angle to the pivot; those without a direction are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                unit = _unit(batch["vec"])
                good = np.isfinite(unit).all(axis=1)
                angle = np.arccos(np.clip(unit[good] @ pivot, -1, 1))
                yield batch[good].assign(angle=angle)

    kinds = dict(rows.dtypes)
    return rows.select("bucket", "id", "vec").mapInPandas(
        run, f"bucket {kinds['bucket']}, id long, vec array<double>, angle double"
    )


class _Strip:
    """The held members of a bucket and their best others so far."""

    def __init__(self, rows: pd.DataFrame, k: int, min_sim: float):
        rows = rows.sort_values("angle", kind="stable")
        self.ids, self.angle, self.unit = rows["id"].to_numpy("int64"), rows["angle"].to_numpy(), _unit(rows["vec"])
        self.k = k
        # How far off in angle a row may be and still be among the best.
        self.widest = math.acos(max(-1.0, min(1.0, min_sim))) + SLACK
        self.reach = np.full(len(rows), self.widest)
        self.best: list[pd.DataFrame] = []
        self.compared = 0

    def pass_by(self, rows: pd.DataFrame) -> None:
        """Compare rows, none of which is one of the held, with the held that they may concern."""
        angle = rows["angle"].to_numpy()
        low, high = angle.min(), angle.max()
        concerned = np.maximum(low - self.angle, self.angle - high) <= self.reach
        if not concerned.any():
            return
        self.compared += int(concerned.sum()) * len(rows)
        ids, unit = rows["id"].to_numpy("int64"), _unit(rows["vec"])
        found = list(_best(self.ids[concerned], self.unit[concerned], ids, unit, self.k, True))
        self.best = [_cut([*self.best, *found], self.k)]
        self._tighten()

    def _tighten(self) -> None:
        top = self.best[0]
        counts = top.groupby("probe", sort=False)["sim"].agg(["size", "min"])
        full = counts[counts["size"] >= self.k]["min"]
        at = pd.Series(np.arange(len(self.ids)), index=self.ids)
        places = at[full.index].to_numpy()
        bound = np.arccos(np.clip(full.to_numpy(), -1, 1)) + SLACK
        self.reach[places] = np.minimum(self.widest, bound)

    def result(self, bucket, min_sim: float) -> Iterator[pd.DataFrame]:
        for top in self.best:
            top = top[top["sim"] >= min_sim]
            if len(top):
                rank = top.groupby("probe", sort=False).cumcount() + 1
                yield pd.DataFrame({"bucket": bucket, "id": top["probe"], "rank": rank, "other": top["id"], "sim": top["sim"]})


def pairs_in_bucket(
    entities: DataFrame,
    k: int = 10,
    min_sim: float = -1.0,
    strip_rows: int = STRIP_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each (id, bucket, vec), its ``k`` most similar others in the bucket, exactly: (bucket, id, rank, other, sim).

    Similarity is the cosine, rounded; ties go to the smaller id, and only
    similarities of at least ``min_sim`` count. An id has one vector per bucket;
    rows without a bucket, and vectors without a direction, match nothing.

    The members of a bucket are ordered by their angle to the mean direction and
    cut into strips, so a bucket of any size is held by many tasks. The others
    pass a strip, nearest angle first: two vectors' angles to a third differ by
    no more than the angle between them, so members whose ``k``-th best is
    nearer than that difference skip the rest, and with ``min_sim`` strips out
    of reach get no copy at all. Only the best leave a task.
    """
    usable = entities.where(F.col("bucket").isNotNull() & F.col("id").isNotNull() & F.col("vec").isNotNull())
    pivot = mean_direction(usable)
    angled = kept(_with_angles(usable, pivot))
    order = [F.asc("angle"), F.asc("id")]
    numbered = number_rows(angled, ["bucket"], order, index="_place", hot_rows=hot_rows, probe=angled)
    numbered = numbered.withColumn("_strip", int_div(F.col("_place"), strip_rows)).drop("_place")
    strips = numbered.groupBy("bucket", "_strip").agg(F.min("angle").alias("_low"), F.max("angle").alias("_high"))
    own = numbered.select("bucket", "_strip", F.lit(-1.0).cast("double").alias("_gap"), "id", "vec", "angle")
    targets = strips.withColumnRenamed("_strip", "_to")
    gap = F.greatest(F.lit(0.0), F.col("_low") - F.col("angle"), F.col("angle") - F.col("_high"))
    passing = numbered.join(targets, "bucket").withColumn("_gap", gap).where(
        (F.col("_to") != F.col("_strip")) & (F.col("_gap") <= math.acos(max(-1.0, min(1.0, min_sim))) + SLACK)
    )
    rows = own.unionByName(passing.select("bucket", F.col("_to").alias("_strip"), "_gap", "id", "vec", "angle"))
    rows = rows.repartition("bucket", "_strip").sortWithinPartitions("bucket", "_strip", "_gap", "id")
    width = max(1, TILE_CELLS // strip_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, held, strip = None, [], None
        for batch in batches:
            cut = (batch["bucket"] != batch["bucket"].shift()) | (batch["_strip"] != batch["_strip"].shift())
            bounds = [*np.flatnonzero(cut), len(batch)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                part = batch.iloc[low:high]
                first = (part["bucket"].iloc[0], part["_strip"].iloc[0])
                if first != name:
                    yield from _finish(name, held, strip)
                    name, held, strip = first, [], None
                mine = (part["_gap"] < 0).to_numpy()
                if mine.any():
                    held.append(part[mine])
                others = part[~mine]
                if len(others):
                    strip = strip or _open(held)
                    for at in range(0, len(others), width):
                        strip.pass_by(others.iloc[at : at + width])
        yield from _finish(name, held, strip)

    def _open(held: list[pd.DataFrame]) -> _Strip:
        rows = pd.concat(held)
        strip = _Strip(rows, k, min_sim)
        # The held are compared among themselves; a row is no partner of its own.
        for at in range(0, len(rows), width):
            strip.pass_by(rows.iloc[at : at + width])
        return strip

    def _finish(name, held, strip) -> Iterator[pd.DataFrame]:
        if name is not None:
            yield from (strip or _open(held)).result(name[0], min_sim)

    kind = dict(entities.dtypes)["bucket"]
    return rows.mapInPandas(run, f"bucket {kind}, id long, rank long, other long, sim double")
