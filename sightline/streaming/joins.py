"""Joins of two streams whose rows arrive at different times."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from sightline.operators.joins import BUFFER_MS


def event_time(stream: DataFrame, column: str, delay_ms: int) -> DataFrame:
    """Make a column the stream's event time; rows later than ``delay_ms`` may be dropped."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(
        column, f"{delay_ms} milliseconds"
    )


def buffered_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str = "left_ts",
    right_ts: str = "right_ts",
    buffer_ms: int = BUFFER_MS,
    how: str = "inner",
    delay_ms: int | None = None,
) -> DataFrame:
    """Pairs with equal keys at most ``buffer_ms`` apart, in either order of arrival.

    The watermarks let Spark drop a buffered row once no partner can follow.
    With ``left_outer`` a left row without partner is given out then, instead
    of being lost. Rows may be ``delay_ms`` late, by default as long as the buffer.
    """
    keys = list(keys)
    delay = buffer_ms if delay_ms is None else delay_ms
    extra = [c for c in right.columns if c not in keys]
    a = event_time(left, left_ts, delay).alias("l")
    b = event_time(right, right_ts, delay).alias("r")
    match = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    span = F.make_dt_interval(secs=F.lit(buffer_ms / 1000))
    match.append(F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") - span)
    match.append(F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + span)
    joined = a.join(b, match, how)
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in extra])


# A row waits with its columns as JSON, written and read by Spark.
_WAITING = "row string, ts long"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Pairs given out at a time, and how finely timers tell times apart.
CHUNK = 10_000
TIMER_MS = 1_000


class _Consume(StatefulProcessor):
    """Buffers of one key: left rows, and right rows that met no waiting left row."""

    def __init__(self, keys: Sequence[str], buffer_ms: int):
        self.keys = list(keys)
        self.buffer_ms = buffer_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getListState("left", _WAITING)
        self.right = handle.getListState("right", _WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came: dict[str, list[tuple[str, int]]] = {"left": [], "right": []}
        for part in rows:
            micros = part["c_ts"].astype("datetime64[us]").astype("int64")
            for side, row, at in zip(part["c_side"], part["c_row"], micros // 1000, strict=True):
                came[side].append((row, int(at)))
        lefts, rights = came["left"], came["right"]
        if lefts and rights:
            yield from self._out(key, ((a, b, "instant") for a, _ in lefts for b, _ in rights))
        elif lefts:
            # The buffer is read as it comes, never held as a whole.
            near = ((a, b, "late_left") for b, bt in self.right.get() for a, at in lefts if self._near(at, bt))
            yield from self._out(key, near)
            self._wait(self.left, lefts)
        else:
            met: set[int] = set()
            yield from self._out(key, self._late_rights(rights, met))
            self._wait(self.right, [r for place, r in enumerate(rights) if place not in met])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for state in (self.left, self.right):
            kept = [row for row in state.get() if row[1] + self.buffer_ms > now]
            if kept:
                state.put(kept)
            else:
                state.clear()
        return iter([])

    def close(self) -> None:
        pass

    def _late_rights(self, rights, met: set[int]):
        for a, at in self.left.get():
            for place, (b, bt) in enumerate(rights):
                if self._near(at, bt):
                    met.add(place)
                    yield a, b, "late_right"

    def _out(self, key, pairs) -> Iterator[pd.DataFrame]:
        chunk = []
        for pair in pairs:
            chunk.append((*key, *pair))
            if len(chunk) == CHUNK:
                yield pd.DataFrame(chunk, columns=[*self.keys, "_left", "_right", "how"])
                chunk = []
        if chunk:
            yield pd.DataFrame(chunk, columns=[*self.keys, "_left", "_right", "how"])

    def _near(self, a: int, b: int) -> bool:
        return abs(a - b) < self.buffer_ms

    def _wait(self, state, rows) -> None:
        if rows:
            state.appendList(rows)
            for time in {-(-(ts + self.buffer_ms) // TIMER_MS) * TIMER_MS for _, ts in rows}:
                self.handle.registerTimer(time)


def consume_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str = "left_ts",
    right_ts: str = "right_ts",
    buffer_ms: int = BUFFER_MS,
    delay_ms: int | None = None,
) -> DataFrame:
    """Buffered join with exact rules per micro-batch: all columns of both sides, and ``how``.

    Rows that meet in one micro-batch pair at once and never wait. A waiting
    left row pairs with every right row that follows; a right row waits only
    when no left row was waiting for it. Rows may be ``delay_ms`` late, by
    default as long as the buffer, so that disorder inside the buffer loses
    nothing. Columns other than the keys must have different names on the two
    sides; they may be of any type that JSON can hold. Needs the RocksDB state
    store.
    """
    keys = list(keys)
    delay = buffer_ms if delay_ms is None else delay_ms
    rest = {}

    def side(df: DataFrame, name: str, ts: str) -> DataFrame:
        rest[name] = df.select(*[c for c in df.columns if c not in keys]).schema
        row = F.to_json(F.struct(*rest[name].names), _JSON)
        return df.select(*keys, F.lit(name).alias("c_side"), F.col(ts).cast("timestamp").alias("c_ts"), row.alias("c_row"))

    both = side(left, "left", left_ts).unionByName(side(right, "right", right_ts))
    kinds = dict(left.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "_left string, _right string, how string"])
    met = both.withWatermark("c_ts", f"{delay} milliseconds").groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Consume(keys, buffer_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    rows = {name: F.from_json(f"_{name}", rest[name], _JSON) for name in rest}
    return met.select(*keys, "how", *[rows[name].alias(f"_{name}") for name in rows]).select(
        *keys, "_left.*", "_right.*", "how"
    )
