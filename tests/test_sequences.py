from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sightline.operators import ranking as W
from sightline.operators import sequences as S


def _kept(n, samples):
    """Positions kept, counted out by hand-sized rules."""
    if samples == -1 or (samples > 0 and n <= samples):
        return list(range(n))
    if samples == 0:
        return []
    step = n // (samples + 1)
    start = (n - (samples - 1) * step) // 2
    return [i for i in range(n) if (i - start) % step == 0]


LENGTHS = [1, 5, 6, 11, 12, 31, 69, 100]


def _boxes(spark, lengths):
    rows = [(n, i) for n in lengths for i in range(n)]
    return spark.createDataFrame(rows, "entity long, idx long")


def test_sampling_counts(spark):
    kept = S.uniform_sample(_boxes(spark, LENGTHS), 5).where("kept")
    got = {r.entity: sorted(r.i) for r in kept.groupBy("entity").agg(F.collect_list("idx").alias("i")).collect()}
    assert [len(got[n]) for n in LENGTHS] == [1, 5, 6, 11, 6, 7, 7, 7]
    assert got[100] == [2, 18, 34, 50, 66, 82, 98]


@pytest.mark.parametrize("samples", [-1, 0, 1, 2, 3, 5])
def test_sampling_flat_equals_nested(spark, samples):
    flat = S.uniform_sample(_boxes(spark, LENGTHS), samples).where("kept")
    got = sorted(map(tuple, flat.select("entity", "idx").collect()))
    assert got == sorted((n, i) for n in LENGTHS for i in _kept(n, samples))
    nested = _boxes(spark, LENGTHS).groupBy("entity").agg(
        F.array_sort(F.collect_list(F.struct("idx", F.lit(b"p").alias("patch")))).alias("boxes")
    )
    sampled = nested.withColumn("boxes", S.sample_nested(F.col("boxes"), samples))
    kept = sampled.select("entity", F.explode(S.kept_nested(F.col("boxes"))).alias("b")).select("entity", "b.idx")
    assert sorted(map(tuple, kept.collect())) == got
    # The boxes stay, only their pixels go.
    assert sampled.select(F.sum(F.size("boxes"))).first()[0] == sum(LENGTHS)


def test_lengths_of_long_sequences(spark):
    got = S.with_length(_boxes(spark, LENGTHS), ["entity"], block=4)
    assert got.count() == sum(LENGTHS) and got.where("n <> entity").count() == 0


def test_kept_samples_need_pixels_and_area(spark):
    rows = [(1, b"p", 2, 3), (2, None, 2, 3), (3, b"p", 0, 3), (4, b"p", 2, 0)]
    df = spark.createDataFrame(rows, "entity long, patch binary, w int, h int")
    assert [r.entity for r in S.kept_samples(df).collect()] == [1]


def test_non_empty(spark):
    df = spark.createDataFrame([(1, [1]), (2, []), (3, None)], "entity long, boxes array<int>")
    assert [r.entity for r in S.non_empty(df).collect()] == [1]


def test_first_sample(spark):
    rows = [(1, 0, None), (1, 3, b"c"), (1, 2, b"b"), (2, 0, None)]
    got = S.first_sample(spark.createDataFrame(rows, "entity long, idx long, patch binary")).collect()
    assert [(r.entity, r.idx, bytes(r.patch)) for r in got] == [(1, 2, b"b")]


def test_fragments(spark):
    frames = spark.range(2500).select(F.lit("v").alias("video"), F.col("id").alias("idx"), (F.col("id") * 2).alias("f"))
    got = sorted(S.fragment_chunks(frames, item="f").collect(), key=lambda r: r.fragment)
    assert [(r.fragment, r.n_frames, r.first_idx, r.last_idx) for r in got] == [
        (0, 1000, 0, 999), (1, 1000, 1000, 1999), (2, 500, 2000, 2499),
    ]
    assert got[2].f == list(range(4000, 5000, 2))


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_numbering_with_a_hot_key(spark, hot_rows):
    """A third of all rows in one key, with ties in the order and a null key."""
    rows = [("hot", i % 7, i) for i in range(400)] + [(f"k{i % 90}", i % 3, i) for i in range(800)]
    rows += [(None, 1, i) for i in range(30)]
    df = spark.createDataFrame(rows, "key string, a long, b long").repartition(5)
    got = W.number_rows(df, ["key"], [F.desc("a"), F.asc("b")], total="n", hot_rows=hot_rows)
    assert got.columns == ["key", "a", "b", "idx", "n"]
    seen = {}
    for r in got.collect():
        seen.setdefault(r["key"], []).append((r.idx, -r.a, r.b, r.n))
    assert sum(map(len, seen.values())) == len(rows)
    for group in seen.values():
        group.sort()
        assert [g[0] for g in group] == list(range(len(group)))
        assert [g[1:3] for g in group] == sorted(g[1:3] for g in group)
        assert {g[3] for g in group} == {len(group)}


def test_hot_keys_by_sample(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in W.hot_keys(df, ["k"], hot_rows=50_000).collect()] == [0]


def test_latest_and_top(spark):
    rows = [(1, 5, "a"), (1, 7, "b"), (2, 1, "c")]
    df = spark.createDataFrame(rows, "node long, ts long, v string")
    assert sorted(map(tuple, W.latest_per_key(df, ["node"], ["ts"]).collect())) == [(1, 7, "b"), (2, 1, "c")]
    top = W.top_per_key(df, ["node"], [F.desc("ts")], 1)
    assert sorted((r.node, r.v, r["rank"]) for r in top.collect()) == [(1, "b", 1), (2, "c", 1)]


def test_signal_pool_keeps_the_last_hundred(spark):
    rows = [(f"t{i:03d}", i) for i in range(101)] + [("t001", 500)]
    pool = {r.task for r in W.recent_signals(spark.createDataFrame(rows, "task string, ts long")).collect()}
    assert len(pool) == 100 and "t000" not in pool and "t001" in pool


def test_links_of_one_node(spark):
    links = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.9), (2, 1, 0.1)], "src long, dst long, sim double")
    assert [(r.dst, r.sim) for r in W.links_of(links, 1).collect()] == [(3, 0.9), (2, 0.5)]


def test_numbering_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    plain = spark.range(1000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), "id")
    df = plain.mapInPandas(count, "k long, id long")
    for hot_rows in (10_000, 100):
        before = seen.value
        numbered = W.number_rows(df, ["k"], [F.asc("id")], total="n", hot_rows=hot_rows, probe=plain)
        rows = numbered.collect()
        assert seen.value - before == 1000
        assert len(rows) == 1000
        for k in (0, 1, 2):
            own = sorted((r.idx, r.id, r.n) for r in rows if r.k == k)
            assert [i for i, _, _ in own] == list(range(len(own))) and {n for _, _, n in own} == {len(own)}
            assert [i for _, i, _ in own] == sorted(i for _, i, _ in own)
