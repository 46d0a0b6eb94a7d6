"""Pruned neighbours against the search without pruning."""

from __future__ import annotations

import numpy as np
import pytest

from sightline.operators import pivots as P
from sightline.operators.similarity import _unit, topk_similar


def _clustered_rows(n=600, centres=12, width=8, seed=0):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, width))
    return [(i, (middle[i % centres] + 0.05 * rng.standard_normal(width)).tolist()) for i in range(n)]


@pytest.mark.parametrize("probe_bytes", [1 << 20, 1500])
def test_same_rows_as_without_pruning(spark, probe_bytes):
    rows = _clustered_rows()
    rows += [(700, rows[5][1]), (701, rows[5][1]), (702, [0.0] * 8), (703, None)]
    gallery = spark.createDataFrame(rows, "id long, vec array<double>").repartition(3)
    probes = gallery.where("id % 7 = 0 or id > 690")
    pivots = P.choose_pivots(gallery)
    indexed = P.clustered(P.with_pivots(gallery, pivots))
    got = P.topk_pruned(probes, indexed, pivots, k=4, probe_bytes=probe_bytes, block_rows=32)
    want = topk_similar(probes.where("vec is not null"), gallery.where("vec is not null"), k=4)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_most_comparisons_are_saved():
    rows = _clustered_rows()
    unit = _unit([v for _, v in rows])
    pivots = unit[:12]
    angles = np.arccos(np.clip(unit @ pivots.T, -1, 1))
    order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1)))
    ids = np.arange(len(rows))
    search = P.Search(ids[:60], unit[:60], pivots, 4, True)
    for low in range(0, len(order), 25):
        part = order[low : low + 25]
        search.pass_by(ids[part], unit[part], angles[part])
    assert search.compared < 0.6 * 60 * len(rows)
    exact = P.Search(ids[:60], unit[:60], pivots, 4, True)
    exact.pass_by(ids, unit, angles)
    assert search.best[0].reset_index(drop=True).equals(exact.best[0].reset_index(drop=True))


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    pivots = P.choose_pivots(none)
    assert P.topk_pruned(none, P.with_pivots(none, pivots), pivots).count() == 0
