"""Interval joins and pairs of a bucket against brute force."""

from __future__ import annotations

import contextlib
import io
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import pairs
from sightline.operators.intervals import interval_join
from sightline.operators.timetree import span_edges


def _plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_every_overlap_once(spark, seed):
    rng = random.Random(seed)

    def spans(n, longest):
        out = []
        for i in range(n):
            start = rng.randint(-500, 500)
            end = start + rng.choice([0, 0, 1, 3, rng.randint(0, longest), -2])
            out.append((rng.choice(["a", "b", None]), i, start if rng.random() < 0.95 else None, end))
        return out

    a, b = spans(150, 40), spans(120, 2000)
    left = spark.createDataFrame(a, "k string, x long, s long, e long")
    right = spark.createDataFrame(b, "k string, y long, s2 int, e2 int")
    want = Counter(
        (x[0], x[1], y[1])
        for x in a
        for y in b
        if x[0] and x[0] == y[0] and None not in (*x, *y) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    )
    for step in (1, 2, 5):
        got = interval_join(left, right, ("s", "e"), ("s2", "e2"), keys=["k"], step=step)
        assert Counter((r.k, r.x, r.y) for r in got.collect()) == want
    assert "NestedLoop" not in _plan(got) and "Cartesian" not in _plan(got)


def test_wide_numbers_points_and_none(spark):
    left = spark.createDataFrame([(1, -(2**62), 2**62), (2, 5, 5)], "x int, s long, e long")
    right = spark.createDataFrame([(1, 5), (2, 2**62), (3, 6)], "y int, t long")
    got = interval_join(left, right, ("s", "e"), ("t", "t"))
    assert sorted((r.x, r.y) for r in got.collect()) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert interval_join(left.limit(0), right, ("s", "e"), ("t", "t")).count() == 0
    assert interval_join(left, right.limit(0), ("s", "e"), ("t", "t")).count() == 0


def test_long_intervals_copy_no_rows(spark):
    """Short intervals beside one that covers everything still meet in short bins alone."""
    short = spark.range(2000).select(F.col("id").alias("x"), (F.col("id") * 10).alias("s"), (F.col("id") * 10 + 3).alias("e"))
    other = short.select(F.col("x").alias("y"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    other = other.unionByName(spark.createDataFrame([(-1, 0, 20_000)], "y long, s2 long, e2 long"))
    assert interval_join(short, other, ("s", "e"), ("s2", "e2")).count() == 4000


def test_buckets_across_hours_and_days(spark):
    entities = spark.createDataFrame(
        [("a", "20240101235959"), ("b", "20240103011559"), ("c", "20240103011600"), ("d", "x"), ("e", None), ("a", "20240101235959")],
        "entity_id string, start_time string",
    )
    spans = spark.createDataFrame([(202401012240, 202401030115), (202401012300, 202401012359)], "bucket_start long, bucket_end long")
    got = sorted((r.bucket_start, r.entity_id) for r in span_edges(entities, spans).collect())
    assert got == [(202401012240, "a"), (202401012240, "b"), (202401012300, "a")]


# Pairs of a bucket.


def _by_hand(rows, k, min_sim):
    out = set()
    for i, bucket, v in rows:
        if bucket is None or v is None or not any(v):
            continue
        found = []
        for j, other, w in rows:
            if other == bucket and j != i and w is not None and any(w):
                sim = round(float(np.dot(v, w) / np.sqrt(np.dot(v, v)) / np.sqrt(np.dot(w, w))), 9)
                if sim >= min_sim:
                    found.append((-sim, j))
        out |= {(bucket, i, n + 1, j, round(-s, 6)) for n, (s, j) in enumerate(sorted(found)[:k])}
    return out


def _rows(seed, n=120, width=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width))
    rows = []
    for i in range(n):
        v = (centres[i % 6] + 0.2 * rng.standard_normal(width)).tolist()
        rows.append((i, "hot" if i % 2 else f"b{i % 5}", v))
    rows += [(500, "hot", [0.0] * width), (501, None, rows[0][2]), (502, "hot", None), (503, "alone", rows[0][2])]
    rows += [(600 + i, "hot", rows[1][2]) for i in range(8)]
    return rows


@pytest.mark.parametrize(("seed", "k", "min_sim"), [(0, 3, -1.0), (1, 5, 0.6), (2, 1, 0.999), (3, 200, 0.2)])
def test_pairs_by_brute_force(spark, seed, k, min_sim):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "id long, bucket string, vec array<double>").repartition(3)
    for strip_rows in (7, 8192):
        got = pairs.pairs_in_bucket(df, k, min_sim, strip_rows=strip_rows, hot_rows=20)
        assert {(r.bucket, r.id, r["rank"], r.other, round(r.sim, 6)) for r in got.collect()} == _by_hand(rows, k, min_sim)
    assert "NestedLoop" not in _plan(got) and "Cartesian" not in _plan(got)


def test_pairs_of_nothing(spark):
    assert pairs.pairs_in_bucket(spark.createDataFrame([], "id long, bucket string, vec array<double>")).count() == 0


def test_a_strip_skips_what_is_too_far():
    import pandas as pd

    def rows(first, angles):
        return pd.DataFrame(
            {"id": first + np.arange(len(angles)), "vec": [[np.cos(a), np.sin(a)] for a in angles], "angle": angles}
        )

    strip = pairs._Strip(rows(0, np.linspace(0, 0.1, 50)), 2, -1.0)
    strip.pass_by(rows(100, np.linspace(0, 0.1, 50)))
    assert strip.compared == 2500
    strip.pass_by(rows(200, np.linspace(1.0, 1.2, 50)))
    assert strip.compared == 2500


def test_half_of_all_rows_in_many_tasks(spark):
    df = spark.range(4000).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("bucket"),
        F.array(F.sin("id"), F.cos(F.col("id") * 3), F.sin(F.col("id") * 7)).alias("vec"),
    )
    # So small a table would be coalesced into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pairs.pairs_in_bucket(df, 2, strip_rows=100).withColumn("p", F.spark_partition_id())
        spread = got.where("bucket = 0").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in spread) == 4000 and len(spread) > 1
