from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline import schema
from sightline.operators import aggregates as G
from sightline.operators import scoring
from sightline.operators import reports
from sightline.schema import ATTRS, SERVER_REPORT
from sightline.sources import files as S
from sightline.sources import logs
from sightline.sources import messages as M

BOX = "video string, serial int, idx int, x int, y int, width int, height int, patch binary"


def _boxes(spark):
    rows = [("v", s, i, i, 2, 3, 4, bytes([s, i]) if i % 2 else None) for s in range(2) for i in range(4)]
    return spark.createDataFrame(rows, BOX)


def test_entities_round_trip(spark, tmp_path):
    root = str(tmp_path / "store")
    headers = spark.createDataFrame([("v", 0, 2, 100), ("v", 1, 2, 300)], "video string, serial int, num int, start_frame int")
    boxes = _boxes(spark)
    for batch_id in (0, 0, 1):
        S.write_entities(headers, boxes, root, batch_id, spread=2)
    back, loaded = S.read_entities(spark, root)
    columns = boxes.columns
    assert sorted(loaded.select(*columns).collect(), key=lambda r: r[1:3]) == sorted(boxes.collect(), key=lambda r: r[1:3])
    assert back.count() == 2 and loaded.count() == 8
    S.write_entities(headers.where("serial = 1"), boxes.where("serial = 1 AND idx < 3"), root, 2)
    assert sorted(tuple(r) for r in S.read_entities(spark, root)[1].groupBy("serial").count().collect()) == [(0, 4), (1, 3)]


def test_folders_under_any_scheme(spark):
    names = ["v/t/0/info.txt", "v/t/0/tracklet.data", "w/t/1/info.txt", "stray.txt"]
    for listed, root in [("hdfs://nn:8020/meta", "/meta"), ("/meta", "hdfs://nn:8020/meta/"), ("file:///meta", "file:/meta")]:
        files = spark.createDataFrame([(f"{listed}/{n}",) for n in names], "path string")
        got = {(r.video, r.serial, r.url) for r in S.stored_dirs(files, root).collect()}
        root = root.rstrip("/")
        assert got == {("v", "0", f"{root}/v/t/0"), ("w", "1", f"{root}/w/t/1")}
        headers = spark.createDataFrame([(f"{listed}/v/t/0/info.txt", f"{listed}/v/t/0", 7)], "path string, url string, num long")
        found = S.headers_of(S.stored_dirs(files, root), headers)
        assert {(r.video, r.num) for r in found.collect()} == {("v", 7), ("w", None)}
    with pytest.raises(ValueError, match="no listed file"):
        S.stored_dirs(files, "/elsewhere")


def test_header_and_sample_lines(spark, tmp_path):
    root = tmp_path / "result"
    lines = S.sample_lines(_boxes(spark).where("serial = 0"))
    for serial in range(2):
        folder = root / "v" / "task" / str(serial)
        os.makedirs(folder)
        (folder / "info.txt").write_text(
            '{"id":{"video-url":"v","serial-number":%d},"tracklet-number":2,"run-frame-index":7,"bounding-boxes":'
            '[{"x":0,"y":2,"width":3,"height":4},{"x":1,"y":2,"width":3,"height":4}]}\n' % serial
        )
    (root / "v" / "task" / "0" / "tracklet.data").write_text("\n".join(r.value for r in lines.collect()))
    (root / "v" / "stray.txt").write_text("x")
    listing = S.list_files(spark, str(root))
    assert listing.count() == 4 and set(listing.columns) == {"path", "length", "modified"}
    dirs = {r.serial: r.url for r in S.stored_dirs(listing, str(root)).collect()}
    assert dirs == {str(s): str(root / "v" / "task" / str(s)) for s in range(2)}

    headers = S.read_headers(spark, str(root / "v" / "task" / "*" / "info.txt"))
    samples = S.read_sample_lines(spark, str(root / "v" / "task" / "*" / "tracklet.data"))
    boxes = S.restore_boxes(headers, samples)
    got = {(r.url[-1], r.idx): r.patch and bytes(r.patch) for r in boxes.collect()}
    assert got == {("0", 0): None, ("0", 1): bytes([0, 1]), ("1", 0): None, ("1", 1): None}
    wanted = spark.createDataFrame([(dirs["0"],), ("/nowhere",)], "url string")
    found = {r.url: r["run-frame-index"] for r in S.headers_of(wanted, headers).collect()}
    assert found == {dirs["0"]: 7, "/nowhere": None}


def test_archive_member(spark):
    df = spark.createDataFrame([("/r/v/t.har/3",), ("/r/v/t/3",), ("har:///r/t.har/1",)], "p string")
    assert [r[0] for r in df.select(S.archive_member(F.col("p"))).collect()] == [
        "har:///r/v/t.har/3", "/r/v/t/3", "har:///r/t.har/1",
    ]


def test_logs(spark, tmp_path):
    runs = spark.createDataFrame([("tracking", "n", 4, 1, 9), ("attr", "n", 0, 2, 5)], "type string, node string, n_samples long, start_ms long, end_ms long")
    for batch_id in (0, 1, 1):
        logs.append_runs(runs, str(tmp_path / "runs"), batch_id)
    cost = {r.type: (r.n_runs, r.ms_per_run, r.ms_per_sample) for r in G.mean_cost(logs.read_runs(spark, str(tmp_path / "runs"))).collect()}
    assert cost == {"tracking": (2, 8, 2), "attr": (2, 3, None)}
    links = spark.createDataFrame([(1, 2, 0.5)], "src long, dst long, sim double")
    for level in ("minute", "hour", "hour"):
        logs.append_links(links, str(tmp_path / "links"), 3, level)
    assert sorted(r.level for r in logs.read_links(spark, str(tmp_path / "links")).collect()) == ["hour", "minute"]


def test_messages_to_next_nodes(spark):
    results = spark.createDataFrame([("t1", 5)], "task string, score long")
    edges = spark.createDataFrame(
        [("t1", "track", "attr", "TRACKLET", "p1"), ("t1", "track", "save_track", "TRACKLET", "p2"), ("t1", "attr", "save_attr", "ATTRIBUTES", "p3")],
        "task string, src string, dst string, output_type string, port string",
    )
    sent = M.address(results, edges, "track")
    assert sorted((r.topic, r.dest_ports[0]) for r in sent.collect()) == [("TRACKLET", "p1"), ("TRACKLET", "p2")]
    record = M.to_records(sent.drop("dst", "dest_ports")).first()
    assert (record.topic, record.key, record.value) == ("TRACKLET", "t1", '{"score":5}')


def test_reports(spark):
    row = {
        "nodeName": "n1", "ip": "-", "devNumList": [0, 1], "processNumAllList": [1],
        "processAllList": [{"index": 1, "pid": 7, "usedGpuMemory": 50}], "devInfosList": [{"index": 0, "utilRate": 9}],
    }
    df = spark.createDataFrame([row], SERVER_REPORT)
    assert [tuple(r) for r in reports.explode_processes(df).collect()] == [("n1", 7, 1, 50)]
    assert reports.explode_devices(df).first().utilRate == 9
    sent = reports.report_messages(df.select("nodeName", "devNumList"), "report-").first()
    assert (sent.topic, sent.value) == ("report-n1", '{"nodeName":"n1","devNumList":[0,1]}')


def test_models_load_once_per_worker(spark, tmp_path):
    seen = tmp_path / "loads"
    seen.mkdir()

    def factory():
        import tempfile

        tempfile.mkstemp(dir=str(seen), prefix=f"{os.getpid()}-")
        return lambda batch: pd.concat([batch, batch]).assign(v=1.0)

    def scored():
        return scoring.score_batches(spark.range(100).repartition(16), factory, "id long, v double", "twice")

    assert scored().count() == 200 and scored().count() == 200
    workers = [name.split("-")[0] for name in os.listdir(seen)]
    assert len(workers) == len(set(workers))


def test_factories_under_one_name_are_told_apart(spark):
    def factory(value):
        return lambda: lambda batch: batch.assign(v=value)

    for value in (1.0, 2.0, 1.0):
        got = scoring.score_batches(spark.range(20).repartition(8), factory(value), "id long, v double", "m")
        assert {r.v for r in got.collect()} == {value}


def test_zero_recognizer(spark):
    boxes = spark.createDataFrame([(1, 0), (1, 1)], "entity long, idx long")
    names = ATTRS[:3]
    schema = "entity long, idx long, " + ", ".join(f"{n} double" for n in names)
    got = scoring.score_batches(boxes, scoring.zero_recognizer(names), schema, "zero-3")
    assert got.count() == 2 and got.where("gender_male <> 0").count() == 0


def test_partition_sizes(spark):
    sizes = G.partition_sizes(spark.range(100, numPartitions=4))
    assert sorted(r.n_rows for r in sizes.collect()) == [25, 25, 25, 25]
    assert [r[0] for r in G.first_column(spark.sql("select 1 as a, 2 as b")).collect()] == [1]


def _sample(kind):
    """A value of a row type, with something in every field."""
    if isinstance(kind, T.StructType):
        return tuple(_sample(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return [_sample(kind.elementType)]
    return "x" if isinstance(kind, T.StringType) else 7


@pytest.mark.parametrize("name", ["SERVER_REPORT", "CONTAINER_REPORT", "CLUSTER_REPORT", "RUN"])
def test_report_rows_survive_json(spark, name):
    kind = getattr(schema, name)
    rows = spark.createDataFrame([_sample(kind), tuple(None for _ in kind)], kind)
    sent = rows.select(F.to_json(F.struct("*")).alias("value"))
    back = sent.select(F.from_json("value", kind).alias("r")).select("r.*")
    assert back.schema == kind and back.collect() == rows.collect()


def test_mean_vectors(spark):
    def factory():
        def score(boxes):
            return pd.DataFrame({"k": boxes.k, "a": boxes.x.astype("float64"), "b": boxes.x.where(boxes.x > 2).astype("float64")})

        return score

    rows = [("u", 1), ("u", 3), ("u", 8), ("v", 1), ("v", 2), (None, 5)]
    df = spark.createDataFrame(rows, "k string, x long").repartition(4)
    got = {r.k: (r.n_samples, r.scores) for r in scoring.mean_vectors(df, factory, ["a", "b"], ["k"], "means").collect()}
    assert got == {"u": (3, [4.0, 5.5]), "v": (2, [1.5, None]), None: (1, [5.0, 5.0])}
    assert scoring.mean_vectors(df.limit(0), factory, ["a", "b"], ["k"], "means").collect() == []


def test_models_of_named_scores_read_an_array(spark):
    def factory():
        return lambda rows: pd.DataFrame({"k": rows.k, "gap": rows.b - rows.a})

    df = spark.createDataFrame([("u", [1.0, 3.5]), ("v", [2.0, None])], "k string, scores array<double>")
    model = scoring.from_vectors(factory, ["a", "b"])
    got = {r.k: r.gap for r in scoring.score_batches(df, model, "k string, gap double", "gap").collect()}
    assert got == {"u": 2.5, "v": None}


def test_means_leave_the_task_that_scores(spark):
    """Boxes meet before they are scored: no scores are shuffled, whatever the batches, and hot keys give the same."""
    rows = [(None if i % 11 == 0 else i % 11, float(i), None if i % 3 == 0 or i % 11 == 4 else i * 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double").repartition(5)
    factory = lambda: lambda batch: batch
    by_key = {}
    for k, a, b in rows:
        by_key.setdefault(k, []).append((a, b))

    def mean(values):
        known = [v for v in values if v is not None]
        return sum(known) / len(known) if known else None

    want = {k: (len(v), [mean(c) for c in zip(*v)]) for k, v in by_key.items()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for hot_rows in (1_000_000, 30):
            means = scoring.mean_vectors(df, factory, ["a", "b"], ["k"], "clustered", hot_rows=hot_rows)
            assert {r.k: (r.n_samples, r.scores) for r in means.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    means = scoring.mean_vectors(df, factory, ["a", "b"], ["k"], "clustered")
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("Exchange") and "Aggregate" not in plan
