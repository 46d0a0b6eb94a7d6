from __future__ import annotations

import dataclasses
import re

from pyspark import cloudpickle
from pyspark.sql import functions as F

from sightline.functions.vectors import encode_feature
from sightline.operators import scoring
from sightline.operators.entities import merge_groups
from sightline.plans import flow
from sightline.plans.commands import COMMANDS
from sightline.schema import ATTRS
from sightline.sources import upserts

VIDEOS = ["CAM01-20240101235900-20240102000500", "CAM02-20240101101500-20240101102000"]


def _tracker(videos):
    found = scoring.score_batches(videos, scoring.stand_in_tracker(), scoring.TRACKS, "flow-tracker")
    box = lambda i: F.struct(
        i.alias("x"), (i * 2).alias("y"), F.lit(3).alias("w"), (i + 1).alias("h"), F.lit(b"p").alias("patch")
    )
    return found.withColumn("boxes", F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_boxes") - 1), box)).drop("n_boxes")


KEYS = ("origin", "video", "serial")


def _models(names):
    return flow.Models(
        tracker=_tracker,
        recognizer=scoring.stand_in_recognizer(names, KEYS),
        extracter=scoring.stand_in_extracter(keys=KEYS),
        reider=scoring.stand_in_reider(names, KEYS),
        names=names,
        label="flow-test",
    )


def _expected(video):
    mark = int(video.split("-")[1]) % 97
    num = 3 + mark % 30
    return {s: (num, 1 + (mark * 31 + s * 17) % 10_000, 1 + (mark + s * 7) % 31) for s in range(num)}


def _kept(n):
    if n <= 5:
        return list(range(n))
    step = n // 6
    start = (n - 4 * step) // 2
    return [i for i in range(n) if (i - start) % step == 0]


# Which groups each command stores.
STORES = {
    "track": {"track"},
    "track-attrrecog": set(),
    "track-reidfeature": set(),
    "track-reid": {"track", "feature"},
    "track-attrrecog-reid": {"track", "attr", "rank"},
    "track-attrrecog-reidfeature": {"track", "attr", "feature"},
    "attrrecog-reidfeature": {"attr", "feature"},
    "attrrecog": {"attr"},
    "attrrecog-reid": {"attr", "rank"},
    "reid": {"rank"},
    "reidfeature": {"feature"},
    "detection": set(),
    "faster": set(),
    "imgclassification": set(),
}


def test_commands_to_entities(spark, tmp_path):
    assert set(STORES) == set(COMMANDS)
    rows = [(i, c, "/v", 1) for i, c in enumerate(STORES)] + [(90, "track", "/v/CAM01", 1), (91, "bogus", "/v", 1)]
    commands = spark.createDataFrame(rows, "command_id long, command string, target string, serial long")
    files = spark.createDataFrame([(f"/v/{v[:5]}/2024-01-01/{v}.mp4",) for v in VIDEOS], "path string")
    names = list(ATTRS)[:4]
    held = [(VIDEOS[0], s, i, 3, i, 2, 3, 4, b"p") for s in (0, 1) for i in range(3)]
    held = spark.createDataFrame(
        held, "video string, serial long, idx int, n int, x long, y long, w long, h long, patch binary"
    )
    old = spark.createDataFrame([(VIDEOS[0], 1, 2.5, 0.0, 0.0, 7.5)], "video string, serial long, " + ", ".join(f"{n} double" for n in names))
    table = str(tmp_path / "entities")
    save = flow.command_saver(table, lambda: files, models=_models(names), stored_boxes=held, stored_attrs=old)
    save(commands, 0)
    save(commands, 0)
    got = upserts.read_entities(spark, table, ["track", "attr", "feature", "rank"])
    rows = {(r.entity_id, r.data_type): r for r in got.collect()}

    tracked = {(v, s) for v in VIDEOS for s in _expected(v)}
    want = {}
    for command, groups in STORES.items():
        level = COMMANDS[command][0]
        on = tracked if level == "video" else {(VIDEOS[0], 0), (VIDEOS[0], 1)} if level == "entity" else {(VIDEOS[0], 1)}
        want |= {(f"{v}_tarid{s}", command): groups for v, s in on if groups}
    assert {k: {g for g in ("track", "attr", "feature", "rank") if r[g] is not None} for k, r in rows.items()} == want

    paths = {r.track.path for (e, c), r in rows.items() if c == "track" and e.startswith("CAM01")}
    own = commands.sparkSession.sql(f"select md5('90|/v/CAM01/2024-01-01/{VIDEOS[0]}.mp4') as t").first().t
    assert paths and all(f"/{own}/" in p for p in paths), "the last task to ask wins"
    for (entity, command), r in rows.items():
        video, serial = entity.split("_tarid")
        fresh = COMMANDS[command][0] == "video"
        num, start_frame, n_boxes = _expected(video)[int(serial)]
        boxes = [(i, i * 2, 3, i + 1) for i in _kept(n_boxes)] if fresh else [(i, 2, 3, 4) for i in range(3)]
        base = [x * 31 + y * 17 + w * 7 + h * 3 for x, y, w, h in boxes]
        scores = [sum((b + 13 * i) % 1000 for b in base) / len(base) for i in range(4)]
        if r.track is not None:
            assert (r.track.num, r.track.start_frame, r.track.cam) == (num, start_frame, video[:5])
        if r.attr is not None:
            assert list(r.attr) == scores
        if r.rank is not None:
            first, last = (2, 7) if command == "reid" else (int(scores[0]), int(scores[3]))
            assert r.rank.ids == [(first * 31 + last + 7 * j) % 10_000 for j in range(10)]
    late = [r.track.start_time for (e, _), r in rows.items() if r.track and e.startswith("CAM01") and r.track.start_frame >= 750]
    assert late and all(t.startswith("20240102") for t in late)


def test_merge_meets_results_where_they_are(spark):
    """What models found is shuffled to its entity once; the merge of all commands moves no wide rows again."""
    commands = spark.createDataFrame([(i, c, "/v", 1) for i, c in enumerate(STORES)], "command_id long, command string, target string, serial long")
    files = spark.createDataFrame([(f"/v/{v}.mp4",) for v in VIDEOS], "path string")
    names = list(ATTRS)[:4]
    held = spark.createDataFrame(
        [(VIDEOS[0], 1, i, 3, i, 2, 3, 4, b"p") for i in range(3)],
        "video string, serial long, idx int, n int, x long, y long, w long, h long, patch binary",
    )
    old = spark.createDataFrame([(VIDEOS[0], 1, 2.5, 0.0, 0.0, 7.5)], "video string, serial long, " + ", ".join(f"{n} double" for n in names))
    merged = merge_groups([flow.entity_updates(commands, files, _models(names), held, old)], ["track", "attr", "feature", "rank"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entity_id" in plan and not re.search(r"hashpartitioning\(entity_id#\w+, data_type", plan)
    assert merged.count() == merged.select("entity_id", "data_type").distinct().count() > 0


def _held(spark, sizes):
    rows = [(VIDEOS[0], s, i, n, i + s, 2, 3, 4, b"p") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "video string, serial long, idx int, n int, x long, y long, w long, h long, patch binary")


def test_models_run_where_the_merge_finds_their_results(spark, tmp_path):
    """Boxes and commands are shuffled to the parts of entities, scores are not; a command has one track for an entity."""
    rows = [(i, "track-attrrecog-reid", "/v", 1) for i in range(20)] + [(20, "attrrecog-reidfeature", "/v", 1)]
    commands = spark.createDataFrame(rows, "command_id long, command string, target string, serial long")
    files = spark.createDataFrame([(f"/v/{v}.mp4",) for v in VIDEOS], "path string")
    names = list(ATTRS)[:4]
    old = spark.createDataFrame([(VIDEOS[0], 1, 2.5, 0.0, 0.0, 7.5)], "video string, serial long, " + ", ".join(f"{n} double" for n in names))
    updates = flow.entity_updates(commands, files, _models(names), _held(spark, {0: 3, 1: 9}), old, part_entities=2)
    groups = ["track", "attr", "feature", "rank"]
    merged = merge_groups([updates], groups)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("ArrowAggregatePython")], "nothing is shuffled once it is scored"
    tracks = updates.where("track IS NOT NULL").select("entity_id", "seq", "track.path").collect()
    assert len(tracks) == sum(len(_expected(v)) for v in VIDEOS) and {r.seq for r in tracks} == {19}
    last = {spark.sql(f"select md5('19|/v/{v}.mp4') as t").first().t for v in VIDEOS}
    assert {r.path.split("/")[-2] for r in tracks} == last
    # Batches have parts of their own, so these are not stored.
    for batch in range(2):
        upserts.write_updates(updates, str(tmp_path / "t"), batch)
    stored = upserts.read_entities(spark, str(tmp_path / "t"), groups)
    assert stored.count() == merged.count() == len(tracks) + 2


def test_long_sequences_are_scored_over_many_tasks(spark):
    """Where every box is sampled, a long sequence gives what it gives in one place."""
    commands = spark.createDataFrame([(1, "attrrecog-reidfeature", "/v", 1), (2, "attrrecog-reid", "/v", 1)], "command_id long, command string, target string, serial long")
    files = spark.createDataFrame([(f"/v/{VIDEOS[0]}.mp4",)], "path string")
    names = list(ATTRS)[:4]
    old = spark.createDataFrame([], "video string, serial long, " + ", ".join(f"{n} double" for n in names))
    models = dataclasses.replace(_models(names), samples=-1)
    held = _held(spark, {0: 3, 1: 9})
    got = [
        sorted(flow.entity_updates(commands, files, models, held, old, long_boxes=most).drop("entity_id_part").collect(), key=str)
        for most in (4, 100)
    ]
    assert got[0] == got[1] and len(got[0]) == 3
    scores = {(r.entity_id[-1], r.data_type): r.attr[0] for r in got[0]}
    base = [(i + 1) * 31 + 2 * 17 + 3 * 7 + 4 * 3 for i in range(9)]
    assert scores[("1", "attrrecog-reid")] == sum(b % 1000 for b in base) / 9


def test_models_travel_after_features_were_stored(spark):
    """What a session keeps of a function it has used does not go to the workers with the models."""
    encode_feature(F.lit(None).cast("array<float>"))
    assert cloudpickle.dumps(flow._entity_models(_models(list(ATTRS)[:4])))
