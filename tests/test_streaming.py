from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.functions.names import start_time
from sightline.operators import joins as J
from sightline.operators import routing
from sightline.operators.similarity import topk_similar
from sightline.operators.timetree import bucket_counts
from sightline.sources import messages as M
from sightline.sources import upserts
from sightline.streaming import joins as SJ
from sightline.streaming import run, savers

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
SIDE = "task string, serial long, id long, ts timestamp"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _at(seconds):
    return T0 + timedelta(seconds=seconds)


def _feed(spark, folder, batches, schema):
    """Write one file per batch; returns a stream that reads one file at a time."""
    for n, rows in enumerate(batches):
        path = f"{folder}/{n:03d}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    import os
    import time

    src = f"{folder}/in"
    os.makedirs(src)
    for n in range(len(batches)):
        part = next(f for f in sorted(os.listdir(f"{folder}/{n:03d}")) if f.endswith(".parquet"))
        os.link(f"{folder}/{n:03d}/{part}", f"{src}/{n:03d}.parquet")
        stamp = time.time() - 1000 + n * 10
        os.utime(f"{src}/{n:03d}.parquet", (stamp, stamp))
    return M.read_files(spark, src, schema=spark.createDataFrame([], schema).schema, max_per_trigger=1)


def _run(stream, tmp_path, spark, name="out"):
    out = str(tmp_path / name)
    query = run.start(stream, str(tmp_path / f"{name}-checkpoint"), savers.append_saver(out), interval=None)
    query.awaitTermination()
    return spark.read.parquet(out), query


def test_buffered_join_matches_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    schema = events.schema

    def side(df, kind, name):
        return df.where(F.col("event_type") == kind).select(
            F.col("user_id").alias("task"),
            F.col("event_id").alias(f"{name}_id"),
            F.col("ts").cast("timestamp").alias(f"{name}_ts"),
        )

    source = str(tmp_path / "events")
    events.write.parquet(source)
    stream = M.read_files(spark, source, schema=schema)
    hour = 3_600_000
    joined = SJ.buffered_join(side(stream, "click", "left"), side(stream, "purchase", "right"), ["task"], buffer_ms=hour)
    got, query = _run(joined, tmp_path, spark)
    assert sum(n for _, n in run.new_messages(query)) > 0
    want = J.buffered_join(side(events, "click", "left"), side(events, "purchase", "right"), ["task"], buffer_ms=hour)
    columns = ["task", "left_id", "right_id"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())
    assert want.count() > 0


# Rows (side, id, second) of each micro-batch, and the pairs they make.
CASES = {
    "both in one batch": ([[("L", 1, 0), ("R", 10, 1)]], {(1, 10, "instant")}),
    "right within the buffer": ([[("L", 1, 0)], [("R", 10, 599)]], {(1, 10, "late_right")}),
    "right after the buffer": ([[("L", 1, 0)], [("R", 10, 601)]], set()),
    "right first": ([[("R", 10, 0)], [("L", 1, 30)]], {(1, 10, "late_left")}),
    "a waiting left row is not used up": (
        [[("L", 1, 0)], [("R", 10, 10)], [("R", 11, 20)]], {(1, 10, "late_right"), (1, 11, "late_right")},
    ),
    "a right row that met a left row does not wait": (
        [[("L", 1, 0)], [("R", 10, 10)], [("L", 2, 20)]], {(1, 10, "late_right")},
    ),
    "rows that met in one batch do not wait": (
        [[("L", 1, 0), ("R", 10, 1)], [("R", 11, 5)], [("L", 2, 9)]], {(1, 10, "instant"), (2, 11, "late_left")},
    ),
}


def _sides(rows, *more):
    return [
        rows.where(f"which = '{w}'").select(
            "task", "serial", F.col("id").alias(f"{n}_id"), F.col("ts").alias(f"{n}_ts"), *[F.col(c).alias(f"{n}_{c}") for c in more]
        )
        for w, n in (("L", "left"), ("R", "right"))
    ]


def test_disorder_inside_the_buffer_loses_nothing(spark, tmp_path):
    """With default arguments a right row pairs though newer rows came first; then the pair is ranked."""
    schema = SIDE + ", which string, vec array<double>, score double"
    rows = [
        [("t", 0, 1, _at(100), "L", [1.0, 0.0], 0.1)],
        [("u", 0, 2, _at(101), "L", [0.0, 1.0], None)],
        [("t", 0, 10, _at(90), "R", [0.5, 0.5], 1 / 3)],
        [("u", 0, 11, _at(102), "R", [0.0, 2.0], float("nan")), ("u", 0, 12, _at(103), "R", None, 2.5e-17)],
    ]
    stream = _feed(spark, str(tmp_path), rows, schema)
    got, _ = _run(SJ.consume_join(*_sides(stream, "vec", "score"), ["task", "serial"]), tmp_path, spark)
    batch = J.consume_join(*_sides(spark.createDataFrame([r for b in rows for r in b], schema), "vec", "score"), ["task", "serial"])
    columns = [c for c in batch.columns if c != "how"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    assert {(r.left_id, r.right_id, r.how) for r in got.collect()} == {
        (1, 10, "late_right"), (2, 11, "late_right"), (2, 12, "late_right"),
    }
    assembled = J.joined_union(got, got.limit(0).drop("how"))
    probes = assembled.select(F.col("left_id").alias("id"), F.col("left_vec").alias("vec")).distinct()
    gallery = assembled.where("right_vec IS NOT NULL").select(F.col("right_id").alias("id"), F.col("right_vec").alias("vec"))
    ranked = topk_similar(probes, gallery, k=1)
    assert {(r.probe, r.id) for r in ranked.collect()} == {(1, 10), (2, 11)}


def test_consume_join_rules(spark, tmp_path):
    batches = [
        [
            (name, 0, 100 * c + i, _at(s), side)
            for c, (name, (parts, _)) in enumerate(CASES.items())
            if n < len(parts)
            for side, i, s in parts[n]
        ]
        for n in range(3)
    ]
    stream = _feed(spark, str(tmp_path), batches, SIDE + ", which string")
    joined = SJ.consume_join(*_sides(stream), ["task", "serial"], delay_ms=3_600_000)
    got, _ = _run(joined, tmp_path, spark)
    want = {
        (name, 100 * c + a, 100 * c + b, how) for c, (name, (_, pairs)) in enumerate(CASES.items()) for a, b, how in pairs
    }
    assert {(r.task, r.left_id, r.right_id, r.how) for r in got.collect()} == want

    # The batch form finds the same micro-batches in the times of the rows.
    rows = spark.createDataFrame([r for b in batches for r in b], SIDE + ", which string")
    batch = J.consume_join(*_sides(rows), ["task", "serial"], batch_ms=2_000)
    assert {(r.task, r.left_id, r.right_id, r.how) for r in batch.collect()} == want


def test_consume_join_forgets(spark, tmp_path):
    """A row leaves the buffer once the watermark has passed it."""
    rows = [[("t", 0, 1, _at(0), "L")], [("u", 0, 2, _at(5000), "L")], [("u", 0, 3, _at(6000), "L")]]
    stream = _feed(spark, str(tmp_path), rows, SIDE + ", which string")
    joined = SJ.consume_join(*_sides(stream), ["task", "serial"], delay_ms=0)
    _, query = _run(joined, tmp_path, spark)
    metrics = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    assert sum(m["numDeletedTimers"] for m in metrics) == 2


MIXED = "entity_id string, data_type string, seq long, path string, start_time string, s1 double, task string"
GROUPS = {"track": ["path", "start_time"], "attr": ["s1"]}


def _buckets(spark):
    return spark.createDataFrame(
        [(2024010100, 202401010000, 202401010029), (2024010100, 202401010030, 202401010059)],
        "hour_key long, bucket_start long, bucket_end long",
    )


def test_savers_share_a_batch_and_repeat_safely(spark, tmp_path):
    rows = [
        [("e1", "p", 1, "/a", "20240101001000", None, "t1"), ("e2", "p", 2, None, None, 0.5, "t1")],
        [("e1", "p", 1, None, None, 0.25, "t1"), ("e1", "p", 2, "/b", "20240101001000", None, "t1")],
        [("e3", "p", 1, "/c", "20240101004500", None, "t9")],
    ]
    stream = _feed(spark, str(tmp_path), rows, MIXED)
    table, edges = str(tmp_path / "table"), str(tmp_path / "edges")
    signals = spark.createDataFrame([("t9", _at(0))], "task string, ts timestamp")
    save = savers.unless_cancelled(
        lambda: signals,
        run.save_all(
            savers.entity_saver(table, GROUPS),
            savers.edge_saver(edges, lambda: _buckets(spark)),
        ),
    )

    def twice(batch, batch_id):
        save(batch, batch_id)
        save(batch, batch_id)

    query = run.start(stream, str(tmp_path / "cp"), twice, interval=None)
    query.awaitTermination()
    assert [b for b, _ in run.new_messages(query)] == [0, 1, 2]
    merged = upserts.read_entities(spark, table, list(GROUPS))
    got = {r.entity_id: (r.path, r.s1) for r in merged.select("entity_id", "track.path", "attr.s1").collect()}
    assert got == {"e1": ("/b", 0.25), "e2": (None, 0.5)}
    placed = upserts.read_edges(spark, edges)
    assert [tuple(r) for r in placed.select("bucket_start", "entity_id").collect()] == [(202401010000, "e1")]
    assert [tuple(r) for r in bucket_counts(placed).collect()] == [(202401010000, 1)]

    probes = spark.createDataFrame([("e2", "p"), ("e2", "p"), ("e9", "p")], "entity_id string, data_type string")
    found = upserts.lookup_entities(spark, table, probes, list(GROUPS))
    assert [(r.entity_id, r.s1) for r in found.select("entity_id", "attr.s1").collect()] == [("e2", 0.5)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi"), "the filter is below the merge"

    # The last batch with rows stays out of the base, as it may still be written.
    assert upserts.compact(spark, table, list(GROUPS), buckets=16) == 0
    current = upserts.current_version(spark, table)
    assert (current.version, current.last_batch, current.buckets) == (0, 0, 16)
    assert upserts.compact(spark, table, list(GROUPS), buckets=16) is None

    def entities():
        rows = upserts.read_entities(spark, table, list(GROUPS)).select("entity_id", "track.path", "attr.s1")
        return {r.entity_id: (r.path, r.s1) for r in rows.collect()}

    assert entities() == got
    upsert = savers.entity_saver(table, GROUPS)
    # A batch that the base already holds changes nothing when it comes again.
    upsert(spark.createDataFrame([("e1", "p", 1, "/old", None, None, "t")], MIXED), 0)
    assert entities() == got
    upsert(spark.createDataFrame([("e2", "p", 1, "/z", None, None, "t")], MIXED), 7)
    upsert(spark.createDataFrame([("e4", "p", 1, "/y", None, None, "t")], MIXED), 8)
    want = got | {"e2": ("/z", 0.5), "e4": ("/y", None)}
    assert entities() == want
    assert upserts.compact(spark, table, list(GROUPS), buckets=16) == 1
    assert entities() == want


def test_lookup_reads_the_folders_of_its_keys(spark, tmp_path):
    table = str(tmp_path / "table")
    upsert = savers.entity_saver(table, GROUPS)
    for batch in range(3):
        rows = [(f"e{i}", "p", 1, f"/{batch}/{i}", None, None, "t") for i in range(batch, 200)]
        upsert(spark.createDataFrame(rows, MIXED), batch)
    upserts.compact(spark, table, list(GROUPS), buckets=32)
    current = upserts.current_version(spark, table)

    def files(probes):
        rows = upserts.base_rows(spark, table, current, probes)
        return rows.select(F.input_file_name().alias("f")).distinct().count()

    keys = "entity_id string, data_type string"
    probes = spark.createDataFrame([("e0", "p"), ("e0", "p")], keys)
    assert files(None) > 25
    assert files(probes) == 1
    assert files(spark.createDataFrame([], keys)) == 0
    found = upserts.lookup_entities(spark, table, probes, list(GROUPS))
    assert [tuple(r) for r in found.select("entity_id", "track.path").collect()] == [("e0", "/0/0")]
    assert upserts.lookup_entities(spark, table, spark.createDataFrame([], keys), list(GROUPS)).count() == 0


def test_archive_paths_once_a_task_is_complete(spark, tmp_path):
    schema = "task string, serial long, num long, entity_id string, data_type string"
    rows = [[("t1", 0, 2, "a0", "p"), ("t2", 0, 1, "b0", "p")], [("t1", 1, 2, "a1", "p"), ("t1", 0, 2, "a0", "p")]]
    so_far, table = [], str(tmp_path / "archive")
    save = savers.archive_saver(table, lambda: spark.createDataFrame(so_far, schema), F.lit("/v"))

    def paths():
        found = upserts.read_entities(spark, table, ["archive"]).select("entity_id", "archive.path")
        return sorted(map(tuple, found.collect()))

    for batch_id, batch in enumerate(rows):
        so_far += batch
        for _ in range(2):
            save(spark.createDataFrame(batch, schema), batch_id)
        assert paths() == [("a0", "/v/t1.har/0"), ("a1", "/v/t1.har/1")] * batch_id + [("b0", "/v/t2.har/0")]


def test_topics_of_one_stream(spark, tmp_path):
    """One reading of a stream, typed and saved topic by topic."""
    schema = "topic string, task string, event_id long, serial long, ts timestamp, payload string"
    rows = [
        [("TRACKLET", "t1", 1, 0, _at(0), '{"k": 5}'), ("URL", "t1", 2, 0, _at(0), None)],
        [("ATTRIBUTES", "t2", 3, 0, _at(1), '{"s": 0.5}'), ("TRACKLET", "t2", 4, 0, _at(1), "no json")],
    ]
    _feed(spark, str(tmp_path), rows, schema)
    stream = M.spread(M.read_files(spark, f"{tmp_path}/in", topics=["TRACKLET", "ATTRIBUTES"], max_per_trigger=1), 0)
    bodies = {"TRACKLET": StructType().add("k", "long"), "ATTRIBUTES": StructType().add("s", "double")}

    def save_topic(topic):
        target = savers.append_saver(str(tmp_path / topic))
        return lambda batch, n: target(routing.topic_split(batch, bodies)[topic], n)

    query = run.start(stream, str(tmp_path / "cp"), run.save_all(*map(save_topic, bodies)), interval=None)
    query.awaitTermination()
    tracks = spark.read.parquet(str(tmp_path / "TRACKLET")).select("event_id", "payload.k").collect()
    assert sorted(map(tuple, tracks)) == [(1, 5), (4, None)]
    scores = spark.read.parquet(str(tmp_path / "ATTRIBUTES")).select("event_id", "payload.s").collect()
    assert [tuple(r) for r in scores] == [(3, 0.5)]


def test_streamed_start_time(spark, tmp_path):
    """Column functions serve streams as they are."""
    stream = _feed(spark, str(tmp_path), [[("20131220184349", 3495)]], "start string, frame long")
    got, _ = _run(stream.select(start_time(F.col("start"), F.col("frame")).alias("t")), tmp_path, spark)
    assert got.first().t == "20131220184828"
