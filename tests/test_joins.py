from __future__ import annotations

import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import aggregates as G
from sightline.operators import entities as E
from sightline.operators import joins as J
from sightline.operators import reports, routing, similarity, timetree
from sightline.plans import commands as C

T0 = datetime(2024, 1, 1)


def _side(spark, name, rows):
    rows = [(k, i, T0 + timedelta(seconds=s)) for k, i, s in rows]
    return spark.createDataFrame(rows, f"task string, {name}_id long, {name}_ts timestamp")


@pytest.mark.parametrize(
    "left, right, want",
    [
        ([("t", 1, 0)], [("t", 10, 599)], [(1, 10)]),
        ([("t", 1, 0)], [("t", 10, 601)], []),
        ([("t", 1, 300)], [("t", 10, 0)], [(1, 10)]),
        ([("t", 1, 0)], [("t", 10, 10), ("t", 11, 20)], [(1, 10), (1, 11)]),
        ([("t", 1, 0)], [("u", 10, 0)], []),
        # Both edges of the buffer, across block borders.
        ([("t", 1, 600)], [("t", 10, 0), ("t", 11, 1200)], [(1, 10), (1, 11)]),
    ],
)
def test_buffered_join(spark, left, right, want):
    pairs = J.buffered_join(_side(spark, "left", left), _side(spark, "right", right), ["task"])
    assert sorted((r.left_id, r.right_id) for r in pairs.collect()) == want


def _random_sides(spark, seed=3):
    rng = np.random.default_rng(seed)
    # A third of all rows share one key.
    keys = np.where(rng.random(400) < 0.34, 0, rng.integers(1, 30, 400))
    times = rng.integers(0, 4000, 400)
    rows = [(f"t{k}", int(i), int(s)) for i, (k, s) in enumerate(zip(keys, times))]
    return rows[:200], rows[200:]


def test_buffered_join_brute_force(spark):
    a, b = _random_sides(spark)
    pairs = J.buffered_join(_side(spark, "left", a), _side(spark, "right", b), ["task"], buffer_ms=250_000)
    got = sorted((r.left_id, r.right_id) for r in pairs.collect())
    assert got == sorted((i, j) for k, i, s in a for m, j, u in b if k == m and abs(s - u) <= 250)


def test_consume_join_brute_force(spark):
    """Walks the batches one by one, holding the two buffers."""
    a, b = _random_sides(spark, 5)
    batch, buffer = 20, 300
    want, waiting_left, waiting_right = set(), [], []
    for n in range(4000 // batch):
        ls = [r for r in a if r[2] // batch == n]
        rs = [r for r in b if r[2] // batch == n]
        near = lambda m: (n - m) * batch < buffer
        both = {k for k, *_ in ls} & {k for k, *_ in rs}
        want |= {(i, j, "instant") for k, i, _ in ls for m, j, _ in rs if k == m}
        for k, j, _ in (r for r in rs if r[0] not in both):
            met = [i for m, i, at in waiting_left if m == k and near(at)]
            want |= {(i, j, "late_right") for i in met}
            if not met:
                waiting_right.append((k, j, n))
        for k, i, _ in (r for r in ls if r[0] not in both):
            want |= {(i, j, "late_left") for m, j, at in waiting_right if m == k and near(at)}
            waiting_left.append((k, i, n))
    pairs = J.consume_join(
        _side(spark, "left", a), _side(spark, "right", b), ["task"], batch_ms=batch * 1000, buffer_ms=buffer * 1000
    )
    got = {(r.left_id, r.right_id, r.how) for r in pairs.collect()}
    assert got == want and {h for *_, h in got} == {"instant", "late_left", "late_right"}


def test_full_outer_split(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "task string, l long")
    right = spark.createDataFrame([("b", 3), ("c", 4)], "task string, r long")
    split = J.full_outer_split(left, right, ["task"])
    assert [tuple(r) for r in split["both"].collect()] == [("b", 2, 3)]
    assert [tuple(r) for r in split["left"].collect()] == [("a", 1)]
    assert [tuple(r) for r in split["right"].collect()] == [("c", 4)]


def test_drop_stored(spark):
    incoming = spark.createDataFrame([(1, "t1"), (1, "t1"), (2, "t1"), (3, "t2")], "entity long, task string")
    stored = spark.createDataFrame([(2,)], "entity long")
    archived = spark.createDataFrame([("t2",)], "task string")
    assert [r.entity for r in J.drop_stored(incoming, stored, ["entity"], archived).collect()] == [1]


def test_valid_edges(spark):
    links = spark.createDataFrame(
        [(1, 2, 0.5, 1), (1, 2, 0.1, 2), (1, 9, 0.3, 1), (2, 1, 0.7, 1)], "src long, dst long, sim double, at long"
    )
    nodes = spark.createDataFrame([(1,), (2,)], "id long")
    got = sorted(map(tuple, J.valid_edges(links, nodes, ["at"]).collect()))
    assert got == [(1, 2, 0.1), (2, 1, 0.7)]


def test_time_buckets(spark):
    buckets = spark.createDataFrame(
        [(2013122018, 201312201830, 201312201859), (2013122400, 201312240000, 201312240029)],
        "hour_key long, bucket_start long, bucket_end long",
    )
    rows = [("in", "20131220184828"), ("last", "20131220185959"), ("before", "20131220182959"), ("none", None)]
    rows += [("in", "20131220184828"), ("rolled", "20131224000059"), ("compat", "20131223240059")]
    placed = timetree.time_bucket_join(spark.createDataFrame(rows, "entity_id string, start_time string"), buckets)
    assert sorted(r.entity_id for r in placed.collect()) == ["in", "last", "rolled"]
    counts = {r.bucket_start: r.n_members for r in timetree.bucket_counts(placed).collect()}
    assert counts == {201312201830: 2, 201312240000: 1}


def test_complete_groups(spark):
    rows = [("a", s, 3) for s in (0, 1, 2, 2)] + [("b", s, 3) for s in (0, 1)]
    got = {r.task: (r.complete, r.missing) for r in G.complete_groups(spark.createDataFrame(rows, "task string, serial long, num long")).collect()}
    assert got == {"a": (True, 0), "b": (False, 1)}


def test_upsert_keeps_other_groups(spark):
    track = "entity_id string, data_type string, path string, seq long"
    first = spark.createDataFrame([("e", "p", "/old", 1)], track)
    again = spark.createDataFrame([("e", "p", "/new", 3)], track)
    scores = spark.createDataFrame([("e", "p", 0.5, 2), ("f", "p", 0.1, 2)], "entity_id string, data_type string, s double, seq long")
    parts = [
        E.as_group(first, "track", ["path"], F.col("seq")),
        E.as_group(scores, "attr", ["s"], F.col("seq")),
        E.as_group(again, "track", ["path"], F.col("seq")),
    ]
    flat = E.flatten_groups(E.merge_groups(parts, ["track", "attr"]), ["track", "attr"])
    assert sorted((r.entity_id, r.path, r.s) for r in flat.collect()) == [("e", "/new", 0.5), ("f", None, 0.1)]


def test_routing(spark):
    m = spark.createDataFrame(
        [("TRACKLET", "t1", ["pedestrian-tracklet-saving"], "x" * 10), ("TRACKLET", "t2", [], "é" * 6), ("URL", "t3", None, "u")],
        "topic string, task string, dest_ports array<string>, payload string",
    )
    assert [r.task for r in routing.for_port(m, "pedestrian-tracklet-saving").collect()] == ["t1"]
    routed = routing.by_reference(m, "payload", F.concat(F.lit("/s/"), "task"), limit=10)
    assert {r.task: (r.stored, r.url, r.payload) for r in routed.collect()} == {
        "t1": (False, None, "x" * 10), "t2": (True, "/s/t2", None), "t3": (False, None, "u"),
    }
    stored = m.select(F.concat(F.lit("/s/"), "task").alias("url"), "payload")
    back = routing.resolve_reference(routed, stored, "payload")
    assert {r.task: r.payload for r in back.collect()} == {"t1": "x" * 10, "t2": "é" * 6, "t3": "u"}
    signals = spark.createDataFrame([("t1", 1)], "task string, ts long")
    assert sorted(r.task for r in routing.drop_cancelled(m, signals).collect()) == ["t2", "t3"]
    with pytest.raises(ValueError):
        routing.topic_split(m, {"nope": "a int"})


# The edges of every command's plan.
EDGES = {
    "track": 1, "track-attrrecog": 1, "track-reidfeature": 1, "track-reid": 3, "track-attrrecog-reid": 6,
    "track-attrrecog-reidfeature": 5, "attrrecog-reidfeature": 2, "attrrecog": 1, "attrrecog-reid": 3,
    "reid": 1, "reidfeature": 1, "detection": 1, "faster": 0, "imgclassification": 0,
}


def test_commands(spark):
    edges = {r.command: r["count"] for r in C.edge_table(spark).groupBy("command").count().collect()}
    assert {c: edges.get(c, 0) for c in C.COMMANDS} == EDGES
    cmds = spark.createDataFrame([("track",), ("rttrack",), ("bogus",)], "command string")
    status = {r.command: r.status for r in C.check_commands(cmds).collect()}
    assert status == {"track": "handled", "rttrack": "not implemented", "bogus": "unsupported"}


def test_fan_out_follows_folders(spark):
    cmds = spark.createDataFrame(
        [(1, "track", "/v/CAM01/", 0), (2, "attrrecog", "/v/CAM01/d1", 0), (3, "reid", "/v/CAM01/d1/b.mp4", 1), (4, "bogus", "/v", 0)],
        "command_id long, command string, target string, serial long",
    )
    paths = ["/v/CAM01/d1/a.mp4", "/v/CAM01/d1/b.mp4", "/v/CAM01/d2/c.mp4", "/v/CAM010/d1/x.mp4"]
    tasks = C.fan_out(cmds, spark.createDataFrame([(p,) for p in paths], "path string")).cache()
    got = sorted((r.command_id, r.video) for r in tasks.collect())
    assert got == [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (3, "b")]
    assert tasks.select("task").distinct().count() == 6
    stored = spark.createDataFrame([("a", 0, "/s/a/0"), ("a", 1, "/s/a/1"), ("b", 1, "/s/b/1")], "video string, serial long, url string")
    fanned = C.entity_fan_out(tasks, stored).collect()
    assert sorted(r.url for r in fanned) == ["/s/a/0", "/s/a/1", "/s/b/1"]
    # Entities of one video share their task.
    assert len({r.task for r in fanned}) == 2
    assert [r.url for r in C.serial_fan_out(tasks, stored).collect()] == ["/s/b/1"]
    nodes = C.plan_nodes(tasks).where("command = 'track'")
    assert nodes.count() == 6 and nodes.where("executed").count() == 0
    ports = {r.command: r.dest_ports for r in C.entry_ports(tasks).collect()}
    assert ports["attrrecog"] == ["pedestrian-tracklet-for-attr-recog"]


def test_entity_fan_out_in_cells(spark):
    # Every video's tasks meet all its entities; rows that repeat or hold nulls stay as they are.
    tasks = spark.createDataFrame(
        [("a", i, "entity") for i in (1, 2, 2, 3, None)]
        + [("b", 9, "entity"), ("b", 8, "video"), (None, 7, "entity"), ("none", 6, "entity")],
        "video string, command_id long, input string",
    ).withColumn("task", F.concat_ws("|", "video", "command_id"))
    stored = spark.createDataFrame(
        [("a", f"/a/{i % 9}") for i in range(12)] + [("a", None), ("b", "/b/0"), (None, "/c/0"), ("c", "/c/1")],
        "video string, url string",
    )
    columns = ["video", "command_id", "input", "task", "url"]
    want = tasks.where("input = 'entity'").join(stored, "video").select(*columns)
    for parts in ({}, {"cell_entities": 4, "cell_tasks": 2}, {"cell_entities": 1, "cell_tasks": 1}):
        got = C.entity_fan_out(tasks, stored, **parts)
        assert got.columns == columns
        assert Counter(got.collect()) == Counter(want.collect()), parts
    assert C.entity_fan_out(tasks.where("video = 'none'"), stored).count() == 0


def test_entity_fan_out_is_spread_and_small_on_disk(spark, tmp_path):
    # 200 videos of 50 tasks and 200 entities; a video's tasks arrive far from each other.
    video = F.concat(F.lit("CAM01-19950102000000-"), F.col("id") % 200)
    tasks = spark.range(0, 10_000, 1, 1).select(
        video.alias("video"), F.lit("entity").alias("input"), F.md5(F.col("id").cast("string")).alias("task")
    )
    stored = spark.range(0, 40_000, 1, 1).select(
        video.alias("video"), F.concat(F.lit("/meta/result/ssd/2018-05-09/"), video, F.lit("/task/"), "id").alias("url")
    )
    C.entity_fan_out(tasks, stored).write.parquet(str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 2_000_000 and written.distinct().count() == 2_000_000
    # One Spark task wrote all rows before, in several bytes each.
    most = written.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most <= 1_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 2_000_000


def test_merge_executed(spark):
    rows = [("p", 1, False), ("p", 1, True), ("p", 2, False), ("p", 2, False)]
    got = G.merge_executed(spark.createDataFrame(rows, "plan string, node long, executed boolean"))
    assert sorted(map(tuple, got.collect())) == [("p", 1, True), ("p", 2, False)]


def test_pid_join_and_devices(spark):
    containers = spark.createDataFrame([("c1", "n", 5), ("c2", "n", 6)], "container string, node string, pid long")
    processes = spark.createDataFrame([("n", 5, 1, 10), ("n", 5, 0, 20), ("n", 5, 1, 5), ("m", 6, 0, 1)], "node string, pid long, gpu long, mem long")
    got = {r.container: (r.index_list, r.mem_list) for r in J.pid_join(containers, processes).collect()}
    assert got == {"c1": ([0, 1], [20, 15]), "c2": ([], [])}
    free = reports.free_devices(
        spark.createDataFrame([("n", 0), ("n", 1)], "node string, device long"), spark.createDataFrame([("n", 1)], "node string, device long")
    )
    assert [tuple(r) for r in free.collect()] == [("n", 0)]
    nested = spark.createDataFrame([([0, 1, 2], [1, 1])], "devNumList array<int>, processNumAllList array<int>")
    assert reports.free_in_report(nested).first().free == [0, 2]


def _features(spark, n, seed, copies=0):
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(n, 8)).astype("float32")
    # A third of all rows are copies of one vector.
    vecs[: n // 3] = vecs[0]
    return vecs, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vec array<float>")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


MANY_BLOCKS = {"broadcast_bytes": 0, "block_bytes": 700, "slice_bytes": 2500}


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "block_bytes": 2500}, MANY_BLOCKS])
def test_topk_brute_force(spark, how):
    vecs, df = _features(spark, 150, 1)
    unit = vecs.astype("float64")
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 9)
    want = set()
    for i in range(len(vecs)):
        best = sorted((j for j in range(len(vecs)) if j != i), key=lambda j: (-sims[i, j], j))[:10]
        want |= {(i, rank + 1, j) for rank, j in enumerate(best)}
    got = {(r.probe, r["rank"], r.id) for r in similarity.topk_similar(df.repartition(4), df.repartition(3), **how).collect()}
    assert got == want


def test_topk_small_and_empty(spark):
    _, df = _features(spark, 3, 2)
    assert similarity.topk_similar(df, df, k=10).count() == 6
    none = df.where("id < 0")
    assert similarity.topk_similar(df, none).count() == 0
    assert similarity.topk_similar(none, df).count() == 0
    assert similarity.topk_similar(none, df, broadcast_bytes=-1).count() == 0
    zero = spark.createDataFrame([(7, [0.0] * 8)], "id long, vec array<float>")
    assert similarity.topk_similar(zero, df).count() == 0


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0}])
def test_topk_task_work_is_bounded(spark, how):
    """More rows make more tasks, even if the gallery is one file; the rows stay the same."""
    _, df = _features(spark, 150, 4)
    one = df.coalesce(1)
    got = similarity.topk_similar(one, one, task_cells=30 * 30, **how)
    want = similarity.topk_similar(one, one, broadcast_bytes=1 << 30)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    exchange = re.search(r"MapInPandas.*?Exchange (\w+)\(.*?(\d+)\), REPARTITION_BY_NUM", plan_text(got), re.S)
    assert int(exchange.group(2)) == 25


def test_topk_floors_keep_ties(spark):
    """Equal vectors over many batches: the smaller ids win, also below a floor that they equal."""
    rows = [(i, [1.0, float(i % 3), 0.0]) for i in reversed(range(300))] + [(7, [1.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, vec array<float>").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = {}
        for r in similarity.topk_similar(df.where("id in (0, 10, 299)"), df, k=4).collect():
            got.setdefault(r.probe, []).append((r["rank"], r.id))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {p: [i for _, i in sorted(v)] for p, v in got.items()} == {0: [3, 6, 9, 12], 10: [1, 4, 7, 7], 299: [2, 5, 8, 11]}


def test_links_by_level(spark):
    times = spark.createDataFrame(
        [(1, "20240101000001"), (2, "20240101000059"), (3, "20240101005900"), (4, "20240101010000")], "id long, start_time string"
    )
    pairs = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.4), (3, 4, 0.9)], "src long, dst long, sim double")
    got = sorted(map(tuple, similarity.sim_by_bucket(pairs, times).select("src", "dst", "level").collect()))
    assert got == [(1, 2, "minute"), (1, 3, "hour")]
