"""From commands to stored entities: every command's tasks follow the edges of its plan.

Models run once for each entity, however many commands ask for it; what they
found is then joined to the tasks. An entity comes either out of tracking or
out of the store, as its command says.
"""

from __future__ import annotations

import math
from base64 import b64encode
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.names import entity_id, start_time, store_path, video_part
from sightline.functions.vectors import pack_series
from sightline.operators.entities import FEATURE, PART, feature_update
from sightline.operators.scoring import from_vectors, mean_rows, mean_vectors, score_parts
from sightline.operators.sequences import has_sample, keeps, kept_samples
from sightline.plans.commands import fan_out, need_table
from sightline.session import kept, kept_in_columns
from sightline.sources.upserts import write_updates

TRACK = ("path", "start_time", "start_frame", "num", "cam", "video")
RANK = ("ids",)

# An entity before a command labels it.
ENTITY = ("video", "serial")

# Where an entity comes from, and which it is.
KEYS = ("origin", *ENTITY)

BOX = ("x", "y", "w", "h")

# What a command asks of an entity: what to store, and with a task the track.
ASK = {
    "command": "string",
    "command_id": "long",
    "save_attr": "boolean",
    "save_feature": "boolean",
    "save_reid": "boolean",
    "fed": "boolean",
    "task": "string",
    "num": "long",
    "start_frame": "long",
}

# Entities whose results one task puts together, about: some 2 KB for each command that asks.
# A file holds the different values of each score once, so fewer tasks store less.
TASK_ENTITIES = 40_000

# Entities whose boxes the models see together, about.
PART_ENTITIES = 2_048

# Where all boxes are sampled, longer sequences are scored over many tasks.
LONG_BOXES = 65_536

# Up to so many entities that are ranked by stored scores are broadcast, some 100 bytes each.
FEW_RANKED = 1_000_000

Tracker = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Models:
    """What runs at the nodes of the plans; ``label`` names the set in the workers.

    ``tracker`` turns distinct videos into (video, serial, num, start_frame, boxes).
    ``recognizer`` and ``extracter`` build models from boxes to (video, serial)
    with scores and with a vector ``vec``; ``reider`` one from (video, serial)
    and scores to the ``ids`` of the most similar entities.
    """

    tracker: Tracker
    recognizer: Callable
    extracter: Callable
    reider: Callable
    names: Sequence[str]
    label: str
    samples: int = 5


def _videos(tasks: DataFrame) -> DataFrame:
    return tasks.where((F.col("input") == "video") & F.col("command").startswith("track"))


def ask(df: DataFrame) -> Column:
    """What a command asks of an entity, as a struct; the columns that ``df`` lacks are null."""
    have = set(df.columns)
    return F.struct(*[(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in ASK.items()])


def asked_entities(tasks: DataFrame, tracked: DataFrame, stored: DataFrame) -> DataFrame:
    """(origin, video, serial, asks): each entity commands work on, and what those commands store, last asking.

    ``tracked`` and ``stored`` are (video, serial). A command's models find the
    same for an entity whichever of its tasks asks, so one ask is enough.
    Commands that store nothing a model finds ask for no entity. The commands
    over a video are gathered before they meet its entities.
    """
    flags = [c for c in need_table(tasks.sparkSession).columns if c != "command"]
    wanted = tasks.where("save_attr OR save_feature OR save_reid")
    last = F.max("command_id").alias("command_id")
    one = F.when(F.col("input") == "serial", F.col("serial")).alias("serial")
    by_input = wanted.groupBy("command", "input", "video", one, *flags).agg(last)
    asks = F.sort_array(F.collect_list(ask(by_input))).alias("asks")

    def by_video(chosen: DataFrame) -> DataFrame:
        return chosen.drop("serial").groupBy("video").agg(asks)

    fresh = by_video(_videos(by_input)).join(tracked, "video")
    held = by_video(by_input.where("input = 'entity'")).join(stored, "video")
    named = by_input.where("input = 'serial'").groupBy(*ENTITY).agg(asks).join(stored, list(ENTITY))
    columns = [*ENTITY, "asks"]
    both = held.select(*columns).unionByName(named.select(*columns)).withColumn("origin", F.lit("stored"))
    return fresh.select(F.lit("tracked").alias("origin"), *columns).unionByName(both)


def any_ask(condition: Callable[[Column], Column]) -> Column:
    """Whether any of an entity's asks fulfils the condition."""
    return F.coalesce(F.exists("asks", condition), F.lit(False))


def track_tasks(tasks: DataFrame, found: DataFrame) -> DataFrame:
    """One row for every command and tracked entity that is stored, with the last of the command's tasks to ask.

    Every task stores its track under a path of its own, and the merge keeps
    that of the last to ask. Which one that is shows before tasks meet the
    entities of a video, so rows don't grow with the product of both.
    """
    last = F.max(F.struct("command_id", "task")).alias("_last")
    stored = _videos(tasks).where("save_track").groupBy("command", "video").agg(last).select("command", "video", "_last.*")
    return stored.join(found.select(*ENTITY, "num", "start_frame"), "video")


def track(root: str, method: str, date: str) -> Column:
    """The group ``track`` of a row of :func:`track_tasks`: each task has a path of its own. Null without a task."""
    video = F.col("video")
    made = {
        "path": store_path(F.lit(root), F.lit(method), F.lit(date), video, F.col("task"), F.col("serial")),
        "start_time": start_time(video_part(video, "start"), F.col("start_frame")),
        "cam": video_part(video, "camera"),
    }
    return F.when(F.col("task").isNotNull(), F.struct(*[made.get(c, F.col(c)).alias(c) for c in TRACK]))


def sampled_boxes(found: DataFrame, samples: int) -> DataFrame:
    """(video, serial, x, y, w, h): arrays of the boxes of tracked entities that uniform sampling keeps."""
    n = F.size("boxes")
    kept = F.filter("boxes", lambda b, i: keeps(i, n, samples) & b.patch.isNotNull() & (b.w * b.h != 0))
    return found.select(*ENTITY, kept.alias("_b")).select(*ENTITY, *[F.col("_b")[c].alias(c) for c in BOX])


def held_boxes(stored: DataFrame, samples: int, long_boxes: int, lie_by: Sequence[str] = ()) -> DataFrame:
    """(video, serial, x, y, w, h): all stored entities, with arrays of the boxes that uniform sampling keeps, in order.

    It keeps few, unless ``samples`` is -1; then the boxes of sequences beyond
    ``long_boxes`` are left to :func:`long_rows`.
    """
    here = has_sample() & keeps(F.col("idx"), F.col("n"), samples)
    if samples == -1:
        here &= F.col("n") <= long_boxes
    boxes = F.sort_array(F.collect_list(F.when(here, F.struct("idx", *BOX))))
    held = stored.groupBy(*lie_by, *ENTITY).agg(boxes.alias("_b"))
    # As arrays of numbers they take half the bytes that rows of boxes take.
    return held.select(*ENTITY, *[F.col("_b")[c].alias(c) for c in BOX])


def long_rows(stored: DataFrame, asked: DataFrame, models: Models, long_boxes: int, keep: Callable) -> DataFrame:
    """(origin, video, serial, x, y, w, h, scores) of long sequences: the first box, and the scores over all, where asked."""
    asks = asked.groupBy(*KEYS).agg(F.max(any_ask(lambda a: a.save_attr | (a.save_reid & a.fed))).alias("_score"))
    long = kept_samples(stored.where(F.col("n") > long_boxes)).select(F.lit("stored").alias("origin"), *ENTITY, "idx", *BOX)
    long = keep(long.join(asks, list(KEYS)))
    first = long.groupBy(*KEYS).agg(F.min_by(F.struct(*BOX), "idx").alias("_b"))
    first = first.select(*KEYS, *[F.array(F.col(f"_b.{c}")).alias(c) for c in BOX])
    return first.join(attributes(long.where("_score"), models), list(KEYS), "left")


def attributes(boxes: DataFrame, models: Models) -> DataFrame:
    """Mean attribute scores of every entity over its sampled boxes, as one array ``scores``."""
    boxes = boxes.select(*KEYS, *BOX)
    return mean_vectors(boxes, models.recognizer, models.names, KEYS, f"{models.label}-attr").drop("n_samples")


def _entity_models(models: Models) -> Callable:
    """Builds what runs on entities with all their boxes: attributes, features and ranks, as far as they are asked for."""
    keys, names = list(KEYS), list(models.names)
    # Workers may not know where the tracker comes from, so it does not travel.
    recognizer, extracter, reider = models.recognizer, models.extracter, models.reider

    def build():
        means = mean_rows(recognizer(), names, keys)
        extract = extracter()
        rank = from_vectors(reider, names)()

        def run(rows: pa.RecordBatch) -> pa.RecordBatch:
            # A part also holds entities without a serial; no model sees them.
            known = rows.column("serial").is_valid() if len(rows) else pa.array([], pa.bool_())
            at = np.flatnonzero(known.to_numpy(zero_copy_only=False))
            entities = rows.select(keys).take(pa.array(at)).to_pandas()
            index = pd.MultiIndex.from_frame(entities)

            def flag(name: str) -> np.ndarray:
                return rows.column(name).fill_null(False).to_numpy(zero_copy_only=False)[at]

            def placed(made: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
                """Values of a model beside their entities, and where there are any."""
                values, found = np.full(len(rows), None, dtype=object), np.zeros(len(rows), dtype=bool)
                if len(made):
                    place = index.get_indexer(pd.MultiIndex.from_frame(made[keys]))
                    ours, place = place >= 0, at[place[place >= 0]]
                    values[place] = pd.Series(list(made[column]), dtype=object).to_numpy()[ours]
                    found[place] = True
                return values, found

            lists = {c: rows.column(c).take(pa.array(at)) for c in BOX}
            owner = pc.list_parent_indices(lists["x"]).to_numpy(zero_copy_only=False)
            boxes = entities.iloc[owner].reset_index(drop=True)
            for c in BOX:
                boxes[c] = lists[c].flatten().to_pandas()

            scores = placed(entities.iloc[:0], "")[0]
            given = rows.column("scores").is_valid().to_numpy(zero_copy_only=False)
            scores[given] = pd.Series(rows.column("scores").to_pandas(), dtype=object).to_numpy()[given]
            due = (flag("_score") & ~given[at])[owner]
            made, scored = placed(means(boxes.loc[due].reset_index(drop=True)), "scores")
            scores[scored] = made[scored]

            first = np.diff(owner, prepend=-1) != 0
            first = boxes.loc[first & flag("_extract")[owner]].reset_index(drop=True)
            vecs, extracted = placed(extract(first) if len(first) else first, "vec")
            vecs = pd.Series([None if v is None else np.asarray(v, "float32") for v in vecs], dtype=object)

            def ranked(values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                has = asked & np.array([v is not None for v in values[at]], dtype=bool)
                if not has.any():
                    return placed(entities.iloc[:0], "")
                return placed(rank(entities.loc[has].reset_index(drop=True).assign(scores=list(values[at][has]))), "ids")

            old = pd.Series(rows.column("old").to_pandas(), dtype=object).to_numpy()
            new_ids, new = ranked(scores, flag("_rank_new"))
            old_ids, had = ranked(old, flag("_rank_old"))
            out = {c: rows.column(c) for c in (*keys, "asks")}
            out |= {
                "scores": pa.array(list(scores), pa.list_(pa.float64())),
                "reid_feature": pa.array([b and b64encode(b).decode() for b in pack_series(vecs)], pa.string()),
                "extracted": pa.array(extracted),
                "ids_new": pa.array(list(new_ids), pa.list_(pa.int64())),
                "ranked_new": pa.array(new),
                "ids_old": pa.array(list(old_ids), pa.list_(pa.int64())),
                "ranked_old": pa.array(had),
            }
            return pa.RecordBatch.from_pydict(out)

        return run

    return build


_MADE = "scores array<double>, reid_feature string, extracted boolean, ids_new array<long>, ranked_new boolean, ids_old array<long>, ranked_old boolean"


def entity_updates(
    commands: DataFrame,
    files: DataFrame,
    models: Models,
    stored_boxes: DataFrame,
    stored_attrs: DataFrame,
    root: str = "/meta/",
    method: str = "ssd",
    date: str = "1970-01-01",
    keep: Callable[[DataFrame], DataFrame] = kept,
    task_entities: int = TASK_ENTITIES,
    part_entities: int = PART_ENTITIES,
    long_boxes: int = LONG_BOXES,
    lie_by: Sequence[str] = (),
    few_ranked: int = FEW_RANKED,
) -> DataFrame:
    """What all commands store, in merge form: groups track, attr, feature and rank.

    ``stored_boxes`` is (video, serial, idx, n, x, y, w, h, patch) and
    ``stored_attrs`` (video, serial, scores), as they were stored before.
    Commands over videos track first; a video that several commands name is
    tracked once. Commands over stored entities use those of their videos, and
    the commands with a serial that one entity. Re-identification ranks by the
    scores of its own plan where attributes feed it, else by the stored ones.
    The last command to ask wins in the merge, also with its track.
    ``keep`` stores what a model found if several steps read it, so that it runs once.

    What models find is many times larger than what they read. So boxes and
    commands are shuffled, once, to the parts of ``PART``, where an entity's
    row holds both; models run there, over about ``part_entities`` together, and
    a merge finds what they made where it was made. A task has about
    ``task_entities``. ``lie_by`` names columns of ``stored_boxes`` that an
    entity decides; if the rows lie by them already, its boxes meet there.
    """
    needs = F.broadcast(need_table(commands.sparkSession))
    tasks = fan_out(commands, files).join(needs, "command")
    found = keep(models.tracker(_videos(tasks).select("video").distinct()))
    held = kept_in_columns(held_boxes(stored_boxes, models.samples, long_boxes, lie_by))
    asked = asked_entities(tasks, found.select(*ENTITY), held.select(*ENTITY))
    old_ranks = any_ask(lambda a: a.save_reid & ~a.fed)
    ranked = keep(asked.where((F.col("origin") == "stored") & old_ranks).select(*ENTITY).distinct())
    # Scores are wide, so they stay where they are unless very many entities are ranked by them.
    chosen = F.broadcast(ranked) if ranked.count() <= few_ranked else ranked
    old = stored_attrs.join(chosen, list(ENTITY), "left_semi").select(*ENTITY, F.array(*models.names).alias("old"))

    # All that is known of an entity comes together in one row.
    tracks = track_tasks(tasks, found)
    sources = [
        asked,
        tracks.select(F.lit("tracked").alias("origin"), *ENTITY, F.array(ask(tracks)).alias("asks")),
        sampled_boxes(found, models.samples).withColumn("origin", F.lit("tracked")),
        held.withColumn("origin", F.lit("stored")),
        old.select(F.lit("stored").alias("origin"), *ENTITY, "old"),
    ]
    if models.samples == -1:
        sources.append(long_rows(stored_boxes, asked, models, long_boxes, keep))
    else:
        sources[0] = sources[0].withColumn("scores", F.lit(None).cast("array<double>"))
    entities = sources[0]
    for source in sources[1:]:
        entities = entities.unionByName(source, allowMissingColumns=True)
    n = held.count() + found.count()
    cores = commands.sparkSession.sparkContext.defaultParallelism
    parts, tasks_of = (max(cores, math.ceil(n / size)) for size in (part_entities, task_entities))
    named = entity_id(F.col("video"), F.col("serial"))
    entities = (
        entities.withColumn(PART, F.pmod(F.xxhash64(named), F.lit(parts)))
        .repartition(tasks_of, PART)
        .groupBy(PART, *KEYS)
        .agg(
            F.flatten(F.collect_list("asks")).alias("asks"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in BOX],
            F.first("old", ignorenulls=True).alias("old"),
            F.first("scores", ignorenulls=True).alias("scores"),
        )
        .where(F.size("asks") > 0)
    )

    # Which models run on an entity.
    entities = entities.withColumns({
        "_score": any_ask(lambda a: a.save_attr | (a.save_reid & a.fed)),
        "_extract": any_ask(lambda a: a.save_feature),
        "_rank_new": any_ask(lambda a: a.save_reid & a.fed),
        "_rank_old": old_ranks,
    })
    schema = entities.select(*KEYS, "asks").schema
    for field in T.StructType.fromDDL(_MADE):
        schema = schema.add(field)
    made = score_parts(entities, _entity_models(models), schema, f"{models.label}-entities", PART)
    made = feature_update(made)
    rows = made.withColumn("_a", F.explode("asks")).drop("asks").select("*", "_a.*")
    attr = F.struct(*[F.get("scores", F.lit(i)).alias(n) for i, n in enumerate(models.names)])
    ids_new, ids_old = (F.when(F.col(f"ranked_{x}"), F.struct(F.col(f"ids_{x}").alias(*RANK))) for x in ("new", "old"))
    return rows.select(
        named.alias("entity_id"),
        F.col("command").alias("data_type"),
        track(root, method, date).alias("track"),
        F.when(F.col("save_attr") & F.col("scores").isNotNull(), attr).alias("attr"),
        F.when(F.col("save_feature") & F.col("extracted"), F.struct(*FEATURE)).alias("feature"),
        F.when(F.col("save_reid"), F.when(F.col("fed"), ids_new).otherwise(ids_old)).alias("rank"),
        F.col("command_id").alias("seq"),
        PART,
    ).where("track IS NOT NULL OR attr IS NOT NULL OR feature IS NOT NULL OR rank IS NOT NULL")


def command_saver(table: str, files: Callable[[], DataFrame], **how) -> Callable[[DataFrame, int], None]:
    """Micro-batch form: run a batch's commands over the files there are now and store the results."""

    def save(batch: DataFrame, batch_id: int) -> None:
        write_updates(entity_updates(batch, files(), **how), table, batch_id)

    return save
