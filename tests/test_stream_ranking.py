"""Ranking in a stream against the batch operator, and the pool of signals carried between batches."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from streams import feed, outcome

from sightline.operators.similarity import topk_similar
from sightline.streaming import ranking

T0 = datetime(2024, 1, 1)
ROWS = "side string, id long, vec array<double>, ts timestamp"
MINUTE = 60_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _rows(n=60):
    rng = np.random.default_rng(3)
    rows = [
        ("probe" if i % 3 == 0 else "gallery", i, rng.standard_normal(4).tolist(), T0 + timedelta(seconds=i))
        for i in range(n)
    ]
    rows += [("gallery", 3, rows[6][2], rows[6][3]), ("gallery", 900, [0.0] * 4, T0), ("probe", 901, [0.0] * 4, T0)]
    rows += [("gallery", 902, None, T0), ("probe", None, rows[0][2], T0)]
    rng.shuffle(rows)
    return [tuple(r) for r in rows]


LAST = [("gallery", 990, [1.0, 0.0, 0.0, 0.0], T0 + timedelta(days=1))]


def _build(wait_ms, blocks=2):
    def build(stream):
        probes, gallery = (stream.where(F.col("side") == s).drop("side") for s in ("probe", "gallery"))
        return ranking.topk_similar(probes, gallery, k=4, wait_ms=wait_ms, blocks=blocks, delay_ms=MINUTE)

    return build


def _lists(rows):
    return sorted((r.probe, r["rank"], r.id, round(r.sim, 6)) for r in rows.collect())


def test_stream_equals_batch_after_disorder_and_restart(spark, tmp_path):
    rows = _rows()
    batches = [rows[i::5] for i in range(5)] + [LAST]
    out = outcome(spark, tmp_path, _build(10 * MINUTE), feed(spark, tmp_path, batches, ROWS), stop_after=(2,))
    df = spark.createDataFrame(rows, ROWS).where("id is not null and vec is not null")
    want = topk_similar(df.where("side = 'probe'"), df.where("side = 'gallery'"), k=4)
    assert _lists(out) == _lists(want)


def test_only_rows_within_the_wait(spark, tmp_path):
    rows = [r for r in _rows() if r[1] is not None and r[1] < 60]
    # An id that comes twice counts once.
    batches = [rows[i::3] for i in range(3)] + [rows[:9]] + [LAST]
    out = outcome(spark, tmp_path, _build(15_000, 3), feed(spark, tmp_path, batches, ROWS))
    want = []
    for side, probe, v, at in rows:
        if side != "probe":
            continue
        sims = {}
        for other, i, w, then in rows:
            if other == "gallery" and i != probe and abs((then - at).total_seconds()) <= 15:
                sim = round(float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), 9)
                sims[i] = max(sim, sims.get(i, -2))
        best = sorted((-s, i) for i, s in sims.items())[:4]
        want += [(probe, n + 1, i, round(-s, 6)) for n, (s, i) in enumerate(best)]
    assert _lists(out) == sorted(want)
