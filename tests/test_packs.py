"""Packs of files: the plan, the round trip, and what readers see of broken batches."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sightline.operators.packs import FILE_BYTES, plan_packs
from sightline.sources import files as S
from sightline.sources import packs


def _expected(rows, target, cell_packs):
    """The plan, file by file."""
    out = {}
    for task in {t for t, _, _ in rows}:
        own = sorted((m, n) for t, m, n in rows if t == task)
        cells = sum(n + FILE_BYTES for _, n in own) // (target * cell_packs) + 1
        filled = {}
        for m, n in own:
            cell = int(hashlib.md5(m.encode()).hexdigest()[:8], 16) % cells
            weight, ends = filled.setdefault(cell, [0, {}])
            pack = (cell << 32) + weight // target
            out[task, m] = (pack, ends.get(pack, 0))
            ends[pack] = ends.get(pack, 0) + n
            filled[cell][0] += n + FILE_BYTES
    return out


def test_plan(spark):
    rows = [("hot", f"{i}/x", i * 37 % 900) for i in range(3000)] + [("small", f"{i}/x", 10) for i in range(3)] + [("none", "0/x", 0)]
    df = spark.createDataFrame(rows, "task string, member string, length long")
    got = {(r.task, r.member): (r.pack, r.offset) for r in plan_packs(df, target=8192, cell_packs=4).collect()}
    assert got == _expected(rows, 8192, 4)
    again = plan_packs(df.repartition(17), target=8192, cell_packs=4).collect()
    assert {(r.task, r.member): (r.pack, r.offset) for r in again} == got
    assert len({p >> 32 for (t, _), (p, _) in got.items() if t == "hot"}) > 20, "a large task is spread over cells"
    assert plan_packs(df.limit(0)).collect() == []


def test_plan_sorts_once(spark):
    rows = [("hot", f"{i}/x", i * 37 % 900 * (i % 4 > 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "task string, member string, length long")
    planned = plan_packs(df, target=4096, cell_packs=2)
    assert {(r.task, r.member): (r.pack, r.offset) for r in planned.collect()} == _expected(rows, 4096, 2)
    plan = planned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Sort \[[^\]]*_cell", plan)) == 1


def test_plan_of_nulls_and_repeated_rows(spark):
    df = spark.createDataFrame([("t", "a", None), ("t", "a", None), ("t", None, 5), (None, "a", 3)], "task string, member string, length long")
    got = plan_packs(df)
    assert sorted((r.member or "", r.length, r.offset) for r in got.where("task = 't'").collect()) == [("", 5, 0), ("a", 0, 5), ("a", 0, 5)]


@pytest.fixture
def tree(tmp_path):
    """Two tasks of a video: ``full`` with all its entities, ``part`` without."""
    held = {}
    for task, serials in (("full", 3), ("part", 1)):
        for serial in range(serials):
            folder = tmp_path / "meta" / "v" / task / str(serial)
            folder.mkdir(parents=True)
            for name, data in (("info.txt", b"{}" * (serial + 1)), ("tracklet.data", bytes(range(50 * serial + 9)))):
                (folder / name).write_bytes(data)
                held[task, f"{serial}/{name}"] = data
    return tmp_path, held


def _packed(spark, base, batch_id, target=700):
    groups = spark.createDataFrame([("full", True), ("part", False)], "task string, complete boolean")
    listed = S.list_files(spark, f"{base}/meta")
    files = packs.task_files(listed, f"{base}/meta", groups)
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/meta")
    return packs.write_packs(files, contents, f"{base}/packs", batch_id, target=target)


def test_round_trip(spark, tree):
    base, held = tree
    full = {m: d for (t, m), d in held.items() if t == "full"}
    for batch_id in (0, 0, 1):
        index = _packed(spark, base, batch_id)
    rows = index.collect()
    assert {r.member: r.length for r in rows} == {m: len(d) for m, d in full.items()}
    assert {(r.task, r.batch_id) for r in rows} == {("full", 1)} and len({r.pack for r in rows}) > 1

    paths = [(f"{base}/meta/v/full.har/{m}",) for m in full] + [(f"{base}/meta/v/full.har/2",), ("/plain/file",)]
    asked = packs.packed_members(spark.createDataFrame(paths, "path string"))
    got = packs.read_members(spark, f"{base}/packs", asked).collect()
    assert {r.member: bytes(r.data) for r in got} == full and len(got) == len(full)
    folder = packs.read_members(spark, f"{base}/packs", asked.where("member = '2'")).collect()
    assert {r.member for r in folder} == {"2/info.txt", "2/tracklet.data"}
    assert packs.read_members(spark, f"{base}/packs", asked.withColumn("task", F.lit("part"))).collect() == []

    for pack in {r.pack for r in rows}:
        whole = b"".join(full[r.member] for r in sorted((r for r in rows if r.pack == pack), key=lambda r: (r.offset, r.length)))
        for lo, hi in ((0, len(whole)), (1, len(whole) - 1), (5, 12)):
            pieces = packs.read_range(spark, f"{base}/packs", 1, "v", "full", pack, lo, hi).orderBy("offset").collect()
            assert b"".join(bytes(p.data) for p in pieces) == whole[lo:hi]


def test_broken_batch_is_not_seen(spark, tree):
    base, held = tree
    _packed(spark, base, 0)
    groups = spark.createDataFrame([("part", True)], "task string, complete boolean")
    files = packs.task_files(S.list_files(spark, f"{base}/meta"), f"{base}/meta", groups)
    none = spark.createDataFrame([], "path string, content binary")
    with pytest.raises(ValueError, match="changed"):
        packs.write_packs(files, none, f"{base}/packs", 1)
    assert {r.task for r in packs.read_index(spark, f"{base}/packs").collect()} == {"full"}


def test_large_files_stay(spark, tree):
    base, held = tree
    got = {r.member for r in _packed(spark, base, 0, target=60).collect()}
    assert got == {m for (t, m), d in held.items() if t == "full" and len(d) < 60}
