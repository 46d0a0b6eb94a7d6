"""Waiting for all members of a group in a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from sightline.operators.joins import BUFFER_MS

# Members are remembered as bits, this many to one entry of the state.
SEGMENT = 1 << 16

_RESULT = "n_stored long, n_declared long, missing long, status string"


class _Gate(StatefulProcessor):
    """Members of one group that were seen, until all have come or time is up."""

    def __init__(self, group: Sequence[str], wait_ms: int, keep_ms: int):
        self.group = list(group)
        self.wait_ms = wait_ms
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "stored long, declared long, deadline long, closed boolean")
        self.seen = handle.getMapState("seen", "segment long", "bits binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        stored, declared, deadline, closed = tuple(self.total.get()) if self.total.exists() else (0, None, None, False)
        due = deadline
        for part in rows:
            if closed:
                continue
            own = part["g_declared"].dropna()
            if len(own):
                declared = max(int(own.max()), -(2**63) if declared is None else declared)
            stored += self._mark(part.loc[part["g_has"], "g_member"].to_numpy("int64"))
            first = int(part["g_ts"].astype("datetime64[us]").astype("int64").min()) // 1000 + self.wait_ms
            due = first if due is None else min(due, first)
        if closed:
            return
        if declared is not None and stored >= declared:
            if deadline is not None:
                self.handle.deleteTimer(deadline)
            yield self._close(key, stored, declared, "complete", due)
            return
        if due != deadline:
            if deadline is not None:
                self.handle.deleteTimer(deadline)
            self.handle.registerTimer(due)
        self.total.update((stored, declared, due, False))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.total.exists():
            return
        stored, declared, deadline, closed = tuple(self.total.get())
        if closed:
            self.total.clear()
        else:
            yield self._close(key, stored, declared, "missing", deadline)

    def close(self) -> None:
        pass

    def _mark(self, members: np.ndarray) -> int:
        """Note members as seen; how many of them are new."""
        new = 0
        members = np.unique(members)
        for segment in np.unique(members // SEGMENT):
            bits = np.zeros(SEGMENT // 8, "uint8")
            name = (int(segment),)
            if self.seen.containsKey(name):
                bits = np.frombuffer(bytes(self.seen.getValue(name)[0]), "uint8").copy()
            before = np.unpackbits(bits).sum()
            own = members[members // SEGMENT == segment] % SEGMENT
            np.bitwise_or.at(bits, own // 8, (128 >> (own % 8)).astype("uint8"))
            new += int(np.unpackbits(bits).sum() - before)
            self.seen.updateValue(name, (bytearray(bits.tobytes()),))
        return new

    def _close(self, key, stored: int, declared: int | None, status: str, due: int) -> pd.DataFrame:
        self.seen.clear()
        if self.keep_ms:
            self.total.update((stored, declared, None, True))
            self.handle.registerTimer(due + self.keep_ms)
        else:
            self.total.clear()
        missing = None if declared is None else declared - stored
        row = (*key, stored, declared, missing, status)
        out = pd.DataFrame([row], columns=[*self.group, "n_stored", "n_declared", "missing", "status"])
        return out.astype({c: "Int64" for c in ("n_stored", "n_declared", "missing")})


def completion_gate(
    stored: DataFrame,
    group: Sequence[str] = ("task",),
    member: str = "serial",
    declared: str = "num",
    time: str = "ts",
    wait_ms: int = BUFFER_MS,
    keep_ms: int | None = None,
    delay_ms: int = 0,
) -> DataFrame:
    """One row per group of a stream: ``complete`` with the member that completes it, or ``missing`` when time is up.

    Time is up once the watermark is ``wait_ms`` past the group's earliest
    member; ``missing`` then says how many were lacking. Members that come again
    count once, a null member counts not at all, and the largest declared number
    holds; with no number declared, ``missing`` is null. After either row the
    members are forgotten. A mark that the group is done stays ``keep_ms``
    longer (by default ``wait_ms``), so that members sent again don't open it
    anew; with 0 nothing stays. Rows may be ``delay_ms`` late.

    Members are whole numbers and kept as bits, so a group of a million takes
    about 128 KB of state. Needs the RocksDB state store.
    """
    group = list(group)
    kinds = dict(stored.dtypes)
    rows = stored.select(
        *group,
        F.coalesce(F.col(member).cast("long"), F.lit(0)).alias("g_member"),
        F.col(member).isNotNull().alias("g_has"),
        F.col(declared).cast("long").alias("g_declared"),
        F.col(time).cast("timestamp").alias("g_ts"),
    )
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in group), _RESULT])
    return rows.withWatermark("g_ts", f"{delay_ms} milliseconds").groupBy(*group).transformWithStateInPandas(
        statefulProcessor=_Gate(group, wait_ms, wait_ms if keep_ms is None else keep_ms),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )
