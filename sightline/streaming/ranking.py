"""Ranking the rows of a stream by similarity while they come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from sightline.operators.joins import BUFFER_MS
from sightline.operators.similarity import CANDIDATE, _best, _unit

# Probes are dealt to this many keys; every key keeps the gallery rows that probes may still need.
BLOCKS = 8

# Gallery rows of one entry of the state.
CHUNK = 1024

# How finely timers tell times apart.
TIMER_MS = 1_000

_NONE = pd.DataFrame({"probe": np.empty(0, "int64"), "id": np.empty(0, "int64"), "sim": np.empty(0)})


def _cut_ids(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of each probe; an id that came more than once counts with its highest similarity."""
    rows = rows.sort_values(["probe", "sim", "id"], ascending=[True, False, True])
    return rows.drop_duplicates(["probe", "id"]).groupby("probe", sort=False).head(k)


class _Rank(StatefulProcessor):
    """The probes of one block that still wait, with their best so far, and the gallery rows within their reach."""

    def __init__(self, k: int, wait_ms: int, skip_self: bool):
        self.k = k
        self.wait_ms = wait_ms
        self.skip_self = skip_self

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.probes = handle.getMapState(
            "probes", "id long", "vec array<double>, ts long, ids array<long>, sims array<double>"
        )
        # Chunks by the time they may be dropped at and a number.
        self.gallery = handle.getMapState(
            "gallery", "due long, n long", "ids array<long>, ts array<long>, vecs array<double>"
        )
        self.numbers = handle.getValueState("numbers", "next long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows), ignore_index=True)
        came["r_ts"] = came["r_ts"].astype("datetime64[us]").astype("int64") // 1000
        new = came[came["r_probe"]].drop_duplicates("r_id")
        new = new[[not self.probes.containsKey((int(i),)) for i in new["r_id"]]]
        passing = came[~came["r_probe"]]
        best: dict[int, list[pd.DataFrame]] = {}
        if len(new):
            for part in self._chunks():
                self._compare(best, self._held(new), part)
        if len(passing):
            own = self._held(passing)
            for held in self._waiting():
                self._compare(best, held, own)
            if len(new):
                self._compare(best, self._held(new), own)
            self._keep(passing)
        for row in new.itertuples():
            found = self._listed(best.pop(int(row.r_id), []))
            self.probes.updateValue((int(row.r_id),), ([float(v) for v in row.r_vec], int(row.r_ts), *found))
        for probe, found in best.items():
            vec, ts, ids, sims = self.probes.getValue((probe,))
            before = pd.DataFrame({"probe": probe, "id": np.array(ids, "int64"), "sim": np.array(sims, "float64")})
            self.probes.updateValue((probe,), (list(vec), ts, *self._listed([before, *found])))
        for at in {self._tick(t + self.wait_ms) for t in came["r_ts"].tolist()}:
            self.handle.registerTimer(at)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        # A row as old as the watermark may still come, so what it could meet stays.
        done = [(i[0], v) for i, v in self.probes.iterator() if v[1] + self.wait_ms < now]
        for probe, (_, _, ids, sims) in done:
            self.probes.removeKey((probe,))
            if len(ids):
                yield pd.DataFrame({"probe": probe, "rank": np.arange(1, len(ids) + 1), "id": list(ids), "sim": list(sims)})
        for name in [tuple(n) for n in self.gallery.keys() if n[0] < now]:
            self.gallery.removeKey(name)

    def close(self) -> None:
        pass

    def _tick(self, ms: int) -> int:
        """The time after ``ms`` at which a timer may tell."""
        return (ms // TIMER_MS + 1) * TIMER_MS

    @staticmethod
    def _held(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return rows["r_id"].to_numpy("int64"), rows["r_ts"].to_numpy("int64"), _unit(rows["r_vec"])

    def _waiting(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ids, times, vecs = [], [], []
        for name, value in self.probes.iterator():
            ids.append(name[0])
            times.append(value[1])
            vecs.append(list(value[0]))
            if len(ids) == CHUNK:
                yield np.array(ids), np.array(times), _unit(vecs)
                ids, times, vecs = [], [], []
        if ids:
            yield np.array(ids), np.array(times), _unit(vecs)

    def _chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for ids, times, vecs in self.gallery.values():
            yield np.array(ids, "int64"), np.array(times, "int64"), np.array(vecs).reshape(len(ids), -1)

    def _keep(self, rows: pd.DataFrame) -> None:
        """Keep gallery rows in chunks that are dropped together."""
        number = self.numbers.get()[0] if self.numbers.exists() else 0
        due = rows["r_ts"].map(lambda t: self._tick(t + self.wait_ms))
        for at, part in rows.groupby(due):
            for low in range(0, len(part), CHUNK):
                ids, times, unit = self._held(part.iloc[low : low + CHUNK])
                self.gallery.updateValue((int(at), number), (ids.tolist(), times.tolist(), unit.ravel().tolist()))
                number += 1
        self.numbers.update((number,))

    def _compare(self, best: dict, held, passing) -> None:
        """Add the best pairs at most the wait apart to their probes' lists."""
        # Rows of one id are compared apart, so that each pass has an id once.
        copy = pd.Series(passing[0]).groupby(passing[0]).cumcount().to_numpy()
        for number in range(copy.max() + 1):
            self._compare_once(best, held, tuple(column[copy == number] for column in passing))

    def _compare_once(self, best: dict, held, passing) -> None:
        (probes, probe_ts, probe_unit), (ids, ts, unit) = held, passing
        near = np.abs(probe_ts[:, None] - ts[None, :]) <= self.wait_ms
        whole = near.all(axis=1)
        found = []
        if whole.any():
            found += _best(probes[whole], probe_unit[whole], ids, unit, self.k, self.skip_self)
        for place in np.flatnonzero(~whole):
            some = near[place]
            one = slice(place, place + 1)
            found += _best(probes[one], probe_unit[one], ids[some], unit[some], self.k, self.skip_self)
        for part in found:
            for probe, rows in part.groupby("probe"):
                best.setdefault(int(probe), []).append(rows)

    def _listed(self, found: list[pd.DataFrame]) -> tuple[list[int], list[float]]:
        top = _cut_ids(pd.concat([_NONE, *found]), self.k) if found else _NONE
        return [int(i) for i in top["id"]], [float(s) for s in top["sim"]]


def topk_similar(
    probes: DataFrame,
    gallery: DataFrame,
    k: int = 10,
    time: str = "ts",
    wait_ms: int = BUFFER_MS,
    skip_self: bool = True,
    blocks: int = BLOCKS,
    delay_ms: int | None = None,
) -> DataFrame:
    """The ``k`` gallery rows most similar to each probe among those at most ``wait_ms`` from it: (probe, rank, id, sim).

    Both are streams of (id, vec, time). A probe waits, with its best so far as
    state; gallery rows that come before or after update them, and the list is
    given out once, when the watermark has passed the wait. So the result does
    not depend on how batches cut the streams. A probe id that comes again while
    the first waits is ignored; a gallery id counts once, with its most similar
    vector. Vectors without a direction match nothing, and a probe that nothing
    matches gives no row. Rows may be ``delay_ms`` late, by default as long as the wait.

    Probes are dealt to ``blocks`` keys by a hash of their id; each key keeps a
    copy of the gallery rows of the last wait and drops them by time, so more
    blocks mean more tasks and more copies. Needs the RocksDB state store.
    """
    delay = wait_ms if delay_ms is None else delay_ms

    def side(df: DataFrame, probe: bool, block) -> DataFrame:
        rows = df.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.col(time).isNotNull())
        return rows.select(
            block.alias("r_block"),
            F.lit(probe).alias("r_probe"),
            F.col("id").cast("long").alias("r_id"),
            F.col("vec").cast("array<double>").alias("r_vec"),
            F.col(time).cast("timestamp").alias("r_ts"),
        )

    own = F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(blocks)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    both = side(probes, True, own).unionByName(side(gallery, False, each))
    ranked = both.withWatermark("r_ts", f"{delay} milliseconds").groupBy("r_block").transformWithStateInPandas(
        statefulProcessor=_Rank(k, wait_ms, skip_self),
        outputStructType=CANDIDATE.replace("probe long,", "probe long, rank long,"),
        outputMode="Append",
        timeMode="EventTime",
    )
    return ranked.select("probe", "rank", "id", "sim")
