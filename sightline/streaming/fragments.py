"""Cutting sequences into fragments while their frames come."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from sightline.operators.joins import BUFFER_MS

_RESULT = "fragment long, n_frames long, first_idx long, last_idx long, n_bytes long, items array<binary>"


class _Fragments(StatefulProcessor):
    """The open fragment of one sequence, and frames that came before their turn."""

    def __init__(self, keys: Sequence[str], frames: int, max_bytes: int, wait_ms: int):
        self.keys = list(keys)
        self.frames = frames
        self.max_bytes = max_bytes
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Number and size of the open fragment, the next frame's place, the last frame's if known, and when to give up.
        self.at = handle.getValueState("at", "fragment long, bytes long, next long, last long, due long")
        self.open = handle.getListState("open", "idx long, item binary")
        self.early = handle.getMapState("early", "idx long", "item binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = tuple(self.at.get()) if self.at.exists() else (0, 0, 0, None, None)
        self.fragment, self.bytes, place, last, due = known
        self.held = [tuple(r) for r in self.open.get()]
        before, latest = due, due
        for part in rows:
            part = part.drop_duplicates("f_idx").sort_values("f_idx")
            ts = part["f_ts"].astype("datetime64[us]").astype("int64").max() // 1000 + self.wait_ms
            latest = int(ts) if latest is None else max(latest, int(ts))
            ends = part.loc[part["f_last"], "f_idx"]
            if len(ends):
                last = int(ends.max())
            for idx, item in zip(part["f_idx"].tolist(), part["f_item"], strict=True):
                if idx == place:
                    yield from self._add(key, idx, item)
                    place += 1
                    while self.early.containsKey((place,)):
                        yield from self._add(key, place, bytes(self.early.getValue((place,))[0]))
                        self.early.removeKey((place,))
                        place += 1
                elif idx > place:
                    self.early.updateValue((idx,), (bytearray(item or b""),))
        if last is not None and place > last:
            yield from self._cut(key)
        self._store(place, last, latest)
        if latest != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(latest)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.at.exists():
            return
        self.fragment, self.bytes, _, _, _ = tuple(self.at.get())
        self.held = [tuple(r) for r in self.open.get()]
        # What is lacking will not come; the frames behind the gap follow in order.
        for idx in sorted(k[0] for k in self.early.keys()):
            yield from self._add(key, idx, bytes(self.early.getValue((idx,))[0]))
        yield from self._cut(key)
        for state in (self.at, self.open, self.early):
            state.clear()

    def close(self) -> None:
        pass

    def _add(self, key, idx: int, item: bytes | None) -> Iterator[pd.DataFrame]:
        item = item or b""
        if self.held and self.bytes + len(item) > self.max_bytes:
            yield from self._cut(key)
        self.held.append((idx, bytearray(item)))
        self.bytes += len(item)
        if len(self.held) >= self.frames:
            yield from self._cut(key)

    def _cut(self, key) -> Iterator[pd.DataFrame]:
        if self.held:
            places = [idx for idx, _ in self.held]
            items = [bytes(item) for _, item in self.held]
            row = (*key, self.fragment, len(items), places[0], places[-1], self.bytes, items)
            names = ["fragment", "n_frames", "first_idx", "last_idx", "n_bytes", "items"]
            yield pd.DataFrame([row], columns=[*self.keys, *names])
            self.fragment, self.bytes, self.held = self.fragment + 1, 0, []

    def _store(self, place: int, last: int | None, due: int) -> None:
        self.at.update((self.fragment, self.bytes, place, last, due))
        if self.held:
            self.open.put(self.held)
        else:
            self.open.clear()


def fragment_chunks(
    frames: DataFrame,
    size: int = 1000,
    max_bytes: int = 64 << 20,
    keys: Sequence[str] = ("video",),
    item: str = "frame",
    last: str = "last",
    time: str = "ts",
    wait_ms: int = BUFFER_MS,
    delay_ms: int = 0,
) -> DataFrame:
    """Fragments of at most ``size`` consecutive frames and ``max_bytes`` bytes, whatever batches the frames come in.

    A frame has its place ``idx`` from 0, its bytes, and in ``last`` whether the
    sequence ends with it. A fragment is given out when it is full, when the next
    frame does not fit, or at the end; a frame above ``max_bytes`` is a fragment
    of its own. Frames that come early wait for the ones before them, frames
    that come again are passed over, a null frame is empty. When nothing more
    has come for ``wait_ms``, what is there is given out, gaps left out, and the
    state is dropped. Rows without key or place are left out. The state of a
    sequence holds one open fragment and the frames ahead of a gap. Rows may be
    ``delay_ms`` late. Needs the RocksDB state store.
    """
    keys = list(keys)
    kinds = dict(frames.dtypes)
    rows = frames.dropna(subset=[*keys, "idx", time]).select(
        *keys,
        F.col("idx").cast("long").alias("f_idx"),
        F.col(item).cast("binary").alias("f_item"),
        F.coalesce(F.col(last), F.lit(False)).alias("f_last"),
        F.col(time).cast("timestamp").alias("f_ts"),
    )
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), _RESULT])
    return rows.withWatermark("f_ts", f"{delay_ms} milliseconds").groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Fragments(keys, size, max_bytes, wait_ms),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
