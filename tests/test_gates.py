"""The gate of a stream: complete groups, late ones, repeated members, restarts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from streams import feed, outcome

from sightline.operators.aggregates import complete_groups
from sightline.streaming.gates import completion_gate

T0 = datetime(2024, 1, 1)
STORED = "task string, serial long, num long, ts timestamp"
MINUTE = 60_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _row(task, serial, num, seconds):
    return (task, serial, num, T0 + timedelta(seconds=seconds))


# Moves the watermark past all others.
LAST = _row("z", None, None, 100_000)


def _gated(rows):
    return {(r.task, r.status, r.n_stored, r.n_declared, r.missing) for r in rows.collect()}


def test_complete_missing_and_repeated(spark, tmp_path):
    batches = [
        [_row("a", 0, 3, 0), _row("a", 1, 3, 1), _row("b", 0, 2, 2), _row("c", 5, None, 3), _row("d", None, 1, 3)],
        [_row("a", 1, 3, 5), _row("a", 2, 3, 6), _row("b", 0, 2, 7), _row("e", 70_000, 2, 8), _row("e", -1, 2, 8)],
        # Sent again after the group was complete.
        [_row("a", 0, 3, 20), _row("a", 1, 3, 21)],
        [_row("f", 0, 1, 400)],
        [LAST],
    ]
    out = outcome(spark, tmp_path, lambda s: completion_gate(s, wait_ms=MINUTE), feed(spark, tmp_path, batches, STORED))
    assert _gated(out) == {
        ("a", "complete", 3, 3, 0),
        ("b", "missing", 1, 2, 1),
        ("c", "missing", 1, None, None),
        ("d", "missing", 0, 1, 1),
        ("e", "complete", 2, 2, 0),
        ("f", "complete", 1, 1, 0),
    }
    assert out.groupBy("task").count().where("count > 1").isEmpty()


def test_state_is_dropped(spark, tmp_path):
    """Nothing is left of a group after its row, and after the mark's time a member opens it anew."""
    batches = [
        [_row("a", 0, 1, 0), _row("b", 0, 2, 0)],
        [_row("x", 0, 1, 1000)],
        [_row("a", 0, 2, 1001)],
        [LAST],
        [_row("y", 0, 1, 200_000)],
    ]
    source = feed(spark, tmp_path, batches, STORED)
    out, query = outcome(spark, tmp_path, lambda s: completion_gate(s, wait_ms=MINUTE, keep_ms=0), source, with_query=True)
    rows = sorted((r.task, r.status, r.missing) for r in out.where("task in ('a', 'b')").collect())
    assert rows == [("a", "complete", 0), ("a", "missing", 1), ("b", "missing", 1)]
    done = [p for p in query.recentProgress if p["stateOperators"]]
    # Only the group without a number, which moved the watermark, may still wait.
    assert done[-1]["stateOperators"][0]["numRowsTotal"] <= 3


@pytest.mark.parametrize("seed", range(1))
def test_restart_and_disorder_give_the_batch_result(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for task in range(25):
        num = rng.randint(1, 6)
        lost = rng.random() < 0.4
        for serial in range(num - lost):
            rows += [_row(f"t{task}", serial, num, rng.random() * 50)] * rng.choice([1, 1, 2])
    rng.shuffle(rows)
    batches = [rows[i::6] for i in range(6)] + [[LAST]]
    source = feed(spark, tmp_path, batches, STORED)
    out = outcome(
        spark, tmp_path, lambda s: completion_gate(s, wait_ms=MINUTE, delay_ms=MINUTE), source, stop_after=(2, 5)
    )
    want = complete_groups(spark.createDataFrame(rows, STORED)).collect()
    got = [r for r in out.collect() if r.task != "z"]
    assert sorted((r.task, r.n_stored, r.n_declared, r.missing, r.status == "complete") for r in got) == sorted(
        (r.task, r.n_stored, r.n_declared, r.missing, r.complete) for r in want
    )
    assert spark.createDataFrame(rows, STORED).select(F.countDistinct("task")).first()[0] == len(got)
