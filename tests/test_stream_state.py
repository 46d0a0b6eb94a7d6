"""State carried between batches: the pool of signals, open fragments, windows and counts."""

from __future__ import annotations

import random
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from streams import feed, outcome

from sightline.operators import sequences, timetree
from sightline.operators.ranking import recent_signals
from sightline.plans.tables import Tables
from sightline.sources import messages as M
from sightline.streaming import fragments, pool, run, savers, windows

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
MINUTE = 60_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _at(seconds):
    return T0 + timedelta(seconds=seconds)


# The pool.

MESSAGES = "topic string, task string, ts timestamp, id long"


def test_pool_reads_the_batch_and_itself_only(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    batches, signals = [], []
    for b in range(7):
        own = [("TERM_SIG", f"t{rng.randint(0, 30)}", _at(b * 100 + i), i) for i in range(rng.choice([0, 6, 9]))]
        signals.append(own)
        batches.append(own + [("TRACKLET", f"t{t}", _at(b * 100 + 50), t) for t in range(30)])
    read = []
    real = pool.recent_signals
    monkeypatch.setattr(pool, "recent_signals", lambda df, *a: read.append(df.count()) or real(df, *a))
    held = pool.SignalPool(str(tmp_path / "pool"), size=5)
    saver = pool.drop_signalled(held, F.col("topic") == "TERM_SIG", savers.append_saver(str(tmp_path / "kept")))
    source, made, schema = feed(spark, tmp_path, batches, MESSAGES)
    for n, path in enumerate(made):
        (tmp_path / "source" / f"{n:03d}.parquet").hardlink_to(path)
        stream = M.read_files(spark, source, schema=schema, max_per_trigger=1)
        # A start for every batch: the pool outlives the query.
        run.start(stream, str(tmp_path / "checkpoint"), saver, interval=None).awaitTermination()
    assert all(n <= 5 + len(own) for n, own in zip(read, signals, strict=True)) and len(read) == 7
    kept = {(r.batch_id, r.task) for r in spark.read.parquet(str(tmp_path / "kept")).collect()}
    for b in range(7):
        so_far = [s for own in signals[: b + 1] for s in own]
        gone = {r.task for r in recent_signals(spark.createDataFrame(so_far, MESSAGES), size=5).collect()}
        assert {t for n, t in kept if n == b} == {f"t{t}" for t in range(30)} - gone


def test_pool_after_a_batch_is_given_again(spark, tmp_path):
    held = pool.SignalPool(str(tmp_path / "pool"), size=2)

    def signals(*rows):
        return spark.createDataFrame([(t, _at(s)) for t, s in rows], "task string, ts timestamp")

    def names(df):
        return sorted(r.task for r in df.collect())

    assert names(held.advance(signals(), 0)) == []
    assert names(held.advance(signals(("a", 1), ("b", 2), (None, 9)), 1)) == ["a", "b"]
    # A re-sent id moves to the front instead of leaving with its older entry.
    for _ in range(2):
        assert names(held.advance(signals(("a", 3), ("c", 4)), 2)) == ["a", "c"]
    assert names(held.advance(signals(), 3)) == ["a", "c"]
    assert names(held.before(signals(), 3)) == ["a", "c"]


# Fragments.

FRAMES = "video string, idx long, frame binary, last boolean, ts timestamp, x long"


def _frames(video, n, seed=0, ends=True):
    rng = random.Random(seed)
    return [(video, i, bytearray(rng.randbytes(rng.randint(0, 9))), ends and i == n - 1, _at(i), i) for i in range(n)]


def _greedy(frames, size, max_bytes):
    out, held = [], []
    for f in sorted(frames, key=lambda f: f[1]):
        if held and (len(held) == size or sum(len(h[2]) for h in held) + len(f[2]) > max_bytes):
            out.append(held)
            held = []
        held.append(f)
    return [*out, held]


LAST = [("z", 0, bytearray(b""), True, _at(100_000), 0)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 20])
def test_fragments_do_not_depend_on_batches(spark, tmp_path, max_bytes):
    whole = {"a": _frames("a", 23, 1), "b": _frames("b", 8, 2), "c": _frames("c", 1, 3), "d": _frames("d", 5, 4, ends=False)}
    rows = [f for v in whole.values() for f in v]
    rows += rows[:10]
    random.Random(3).shuffle(rows)
    batches = [rows[i::4] for i in range(4)] + [LAST]
    out = outcome(
        spark,
        tmp_path,
        lambda s: fragments.fragment_chunks(s, size=4, max_bytes=max_bytes, wait_ms=MINUTE, delay_ms=MINUTE),
        feed(spark, tmp_path, batches, FRAMES),
        stop_after=(2,),
    ).where("video <> 'z'")
    got = {(r.video, r.fragment): (r.first_idx, r.last_idx, r.n_bytes, [bytes(i) for i in r["items"]]) for r in out.collect()}
    want = {}
    for video, frames in whole.items():
        for n, part in enumerate(_greedy(frames, 4, max_bytes)):
            items = [bytes(f[2]) for f in part]
            want[video, n] = (part[0][1], part[-1][1], sum(map(len, items)), items)
    assert got == want
    if max_bytes > 100:
        batch = sequences.fragment_chunks(spark.createDataFrame([f for v in whole.values() for f in v], FRAMES), size=4)
        columns = ["video", "fragment", "n_frames", "first_idx", "last_idx"]
        assert sorted(out.select(*columns).collect()) == sorted(batch.select(*columns).collect())


def test_a_gap_is_left_out_when_time_is_up(spark, tmp_path):
    frames = [f for f in _frames("a", 9, 5) if f[1] != 4]
    build = lambda s: fragments.fragment_chunks(s, size=3, wait_ms=MINUTE)
    out = outcome(spark, tmp_path, build, feed(spark, tmp_path, [frames, LAST], FRAMES)).where("video = 'a'")
    assert sorted((r.first_idx, r.last_idx, r.n_frames) for r in out.collect()) == [(0, 2, 3), (3, 6, 3), (7, 8, 2)]


# Windows and counts.


def test_window_totals_equal_the_batch(spark, tmp_path):
    t = Tables(spark, SF)
    entities = t.entities().select("entity_id", "start_time").persist()
    rows = [tuple(r) for r in entities.orderBy("start_time").collect()]
    batches = [rows[i : i + 400] for i in range(0, len(rows), 400)]
    # Sent again at once, and a last one that moves the watermark.
    batches[1] += batches[1][:50]
    batches.append([("end", "20300101000000"), ("bad", "x"), ("none", None)])
    buckets = t.time_buckets()
    out = outcome(
        spark,
        tmp_path,
        lambda s: windows.bucket_counts(s, buckets),
        feed(spark, tmp_path, batches, "entity_id string, start_time string"),
    )
    want = timetree.bucket_counts(timetree.time_bucket_join(entities, buckets))
    assert sorted(map(tuple, out.drop("batch_id").collect())) == sorted(map(tuple, want.select("bucket_start", "n_members").collect()))


def test_counts_per_topic_and_partition(spark, tmp_path):
    rng = random.Random(4)
    schema = "topic string, partition long, ts timestamp"
    batches = [
        [(rng.choice(["a/b", "c", "d", None]), rng.randint(0, 2), _at(b * 4000 + i)) for i in range(40)] for b in range(3)
    ]
    seen = {}
    listener = windows.TopicListener(lambda batch, counts: seen.__setitem__(batch, counts))
    spark.streams.addListener(listener)
    fed = feed(spark, tmp_path, [*batches, [("c", 0, _at(10**6))]], schema)
    build = lambda s: windows.window_counts(windows.observe_topics(s, ["a/b", "c"], 2))
    try:
        out = outcome(spark, tmp_path, build, fed)
        for _ in range(50):
            if len(seen) >= 4:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    for batch, rows in enumerate(batches):
        want = Counter((t, p) if t in ("a/b", "c") and p < 2 else ("other", None) for t, p, _ in rows)
        assert Counter({(t, p): n for t, p, n in seen[batch]}) == want
    want = Counter((r[2].replace(minute=0, second=0), r[0], r[1]) for b in batches for r in b)
    assert {tuple(r)[:3]: r.n_messages for r in out.collect()} == want
