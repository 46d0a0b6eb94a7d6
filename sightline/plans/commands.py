"""Commands: validation, fan-out into tasks, and the plan each one runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.names import file_stem
from sightline.session import kept

# About this many entities and tasks of a video meet in one cell. A Spark task
# makes the messages of about one cell, and one file holds few different urls.
CELL_ENTITIES = 4096
CELL_TASKS = 8192

# Urls of a video that are handed to one task after another.
LIST_URLS = 256

# What each plan node outputs.
NODE_OUTPUT = {
    "track": "TRACKLET",
    "attr": "ATTRIBUTES",
    "feature": "REID_FEATURE",
    "reid": "IDRANK",
    "detect": "DETECTION",
    "classify": "CLASSIFIER",
    "faster": "FASTER",
    "save_track": "NONE",
    "save_attr": "NONE",
    "save_feature": "NONE",
    "save_rank": "NONE",
    "save_detect": "NONE",
}

# The port through which one node feeds another.
EDGE_PORT = {
    ("track", "attr"): "pedestrian-tracklet-for-attr-recog",
    ("track", "feature"): "pedestrian-tracklet-for-reid-feature-extraction",
    ("track", "reid"): "pedestrian-tracklet-for-reid-using-attr",
    ("attr", "reid"): "pedestrian-attr-for-reid-using-attr",
    ("track", "save_track"): "pedestrian-tracklet-saving",
    ("attr", "save_attr"): "pedestrian-attr-saving",
    ("feature", "save_feature"): "pedestrian-reid-feature-saving",
    ("reid", "save_rank"): "pedestrian-idrank-saving",
    ("detect", "save_detect"): "pedestrian-detection-saving",
}

# Command, the stored input it starts on, entry ports, edges.
COMMANDS = {
    "track": ("video", ["hdfs-video-url-for-pedestrian-tracking"], "track>save_track"),
    "track-attrrecog": ("video", ["hdfs-video-url-for-pedestrian-tracking"], "track>attr"),
    "track-reidfeature": ("video", ["hdfs-video-url-for-pedestrian-tracking"], "track>feature"),
    "track-reid": (
        "video",
        ["hdfs-video-url-for-pedestrian-tracking"],
        "track>feature track>save_track feature>save_feature",
    ),
    "track-attrrecog-reid": (
        "video",
        ["hdfs-video-url-for-pedestrian-tracking"],
        "track>attr track>reid attr>reid track>save_track attr>save_attr reid>save_rank",
    ),
    "track-attrrecog-reidfeature": (
        "video",
        ["hdfs-video-url-for-pedestrian-tracking"],
        "track>attr track>feature track>save_track attr>save_attr feature>save_feature",
    ),
    "attrrecog-reidfeature": (
        "entity",
        ["pedestrian-tracklet-for-attr-recog", "pedestrian-tracklet-for-reid-feature-extraction"],
        "attr>save_attr feature>save_feature",
    ),
    "attrrecog": ("entity", ["pedestrian-tracklet-for-attr-recog"], "attr>save_attr"),
    "attrrecog-reid": (
        "serial",
        ["pedestrian-tracklet-for-attr-recog", "pedestrian-tracklet-for-reid-using-attr"],
        "attr>reid attr>save_attr reid>save_rank",
    ),
    "reid": ("serial", ["pedestrian-track-attr-for-reid-using-attr"], "reid>save_rank"),
    "reidfeature": ("entity", ["pedestrian-tracklet-for-reid-feature-extraction"], "feature>save_feature"),
    "detection": ("video", ["hdfs-video-url-for-pedestrian-detection"], "detect>save_detect"),
    "faster": ("video", ["hdfs-video-url-for-pedestrian-faster"], ""),
    "imgclassification": ("video", ["hdfs-video-url-for-pedestrian-classifier"], ""),
}

# The node that stores the output of another.
SAVERS = {"track": "save_track", "attr": "save_attr", "feature": "save_feature", "reid": "save_rank"}

# Known commands without an implementation.
NOT_IMPLEMENTED = ["rttrack", "rt-track-attrrecog-reid"]

# The node at which a port enters a plan.
_START_NODE = {
    "hdfs-video-url-for-pedestrian-tracking": "track",
    "hdfs-video-url-for-pedestrian-detection": "detect",
    "hdfs-video-url-for-pedestrian-faster": "faster",
    "hdfs-video-url-for-pedestrian-classifier": "classify",
    "pedestrian-tracklet-for-attr-recog": "attr",
    "pedestrian-tracklet-for-reid-feature-extraction": "feature",
    "pedestrian-tracklet-for-reid-using-attr": "reid",
    "pedestrian-track-attr-for-reid-using-attr": "reid",
}


def _constant(spark: SparkSession, columns: str, rows) -> DataFrame:
    """A table held in the plan itself, so that Spark knows how small it is."""
    def cell(v):
        return "cast(null as string)" if v is None else f"'{v}'"

    values = ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({columns})")


def command_table(spark: SparkSession) -> DataFrame:
    """Known commands, whether they run, and the stored input they start on."""
    rows = [(c, "handled", level) for c, (level, _, _) in COMMANDS.items()]
    rows += [(c, "not implemented", None) for c in NOT_IMPLEMENTED]
    return _constant(spark, "command, status, input", rows)


def entry_table(spark: SparkSession) -> DataFrame:
    """Ports at which a command's tasks enter its plan."""
    rows = [(c, _START_NODE[p], p) for c, (_, ports, _) in COMMANDS.items() for p in ports]
    return _constant(spark, "command, node, port", rows)


def edge_table(spark: SparkSession) -> DataFrame:
    """Edges of every command's plan, with the output type that travels on them."""
    rows = []
    for command, (_, _, edges) in COMMANDS.items():
        for edge in edges.split():
            src, dst = edge.split(">")
            rows.append((command, src, dst, NODE_OUTPUT[src], EDGE_PORT[src, dst]))
    return _constant(spark, "command, src, dst, output_type, port", rows)


def node_table(spark: SparkSession) -> DataFrame:
    """Nodes of every command's plan."""
    rows = []
    for command, (_, ports, edges) in COMMANDS.items():
        nodes = {_START_NODE[p] for p in ports} | {n for e in edges.split() for n in e.split(">")}
        rows += [(command, n, NODE_OUTPUT[n]) for n in NODE_OUTPUT if n in nodes]
    return _constant(spark, "command, node, output_type", rows)


def need_table(spark: SparkSession) -> DataFrame:
    """What every command's plan stores, and whether attributes feed its re-identification."""
    rows = []
    for command, (_, ports, edges) in COMMANDS.items():
        known = set(edges.split())
        runs = {_START_NODE[p] for p in ports} | {e.split(">")[1] for e in known}
        saves = [n in runs and f"{n}>{saver}" in known for n, saver in SAVERS.items()]
        rows.append((command, *(str(s).lower() for s in (*saves, "attr>reid" in known))))
    names = [f"save_{n}" for n in SAVERS] + ["fed"]
    table = _constant(spark, ", ".join(["command", *names]), rows)
    return table.select("command", *[F.col(n).cast("boolean").alias(n) for n in names])


def check_commands(commands: DataFrame) -> DataFrame:
    """Add ``status`` (handled, not implemented, unsupported) and the ``input`` of handled commands."""
    known = command_table(commands.sparkSession)
    return commands.join(known, "command", "left_outer").withColumn(
        "status", F.coalesce("status", F.lit("unsupported"))
    )


def ancestors(path: Column) -> Column:
    """The path itself and every folder above it, without the root."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )


def task_key(*parts: Column) -> Column:
    """Repeatable task id from what makes the task, so that a retried batch makes the same tasks."""
    return F.md5(F.concat_ws("|", *parts))


def fan_out(commands: DataFrame, files: DataFrame) -> DataFrame:
    """One task for every file below a command's path.

    Files are listed under each of their folders and joined on equality, so the
    work is files times depth instead of files times commands.
    """
    runnable = check_commands(commands).where(F.col("status") == "handled")
    listed = files.select("path", F.explode(ancestors(F.col("path"))).alias("folder"))
    target = F.regexp_replace("target", "/+$", "").alias("folder")
    return (
        runnable.select("command_id", "command", "input", *_params(commands), target)
        .join(listed, "folder")
        .drop("folder")
        .withColumn("video", file_stem(F.col("path")))
        .withColumn("task", task_key(F.col("command_id").cast("string"), F.col("path")))
    )


def _params(commands: DataFrame) -> list[str]:
    return [c for c in ("serial",) if c in commands.columns]


def entity_fan_out(
    tasks: DataFrame, stored: DataFrame, cell_entities: int = CELL_ENTITIES, cell_tasks: int = CELL_TASKS
) -> DataFrame:
    """One message per stored entity of a task's video; they share the task id.

    Applies to the commands that start on stored entities.

    There are as many messages as the product of a video's tasks and entities,
    so both are cut into parts, and every two parts meet in a cell of about
    ``cell_entities`` times ``cell_tasks``: more messages make more Spark tasks.
    A cell hands one short list of urls after the other to all its tasks.
    Messages of one task then follow each other and the same urls return in the
    same order, which columnar files store in a fraction of a byte a message.
    """
    asked = tasks.where(F.col("input") == "entity")
    urls = stored.select("video", "url")
    n_tasks = asked.groupBy("video").agg(F.count(F.lit(1)).alias("_n_tasks"))
    n_urls = urls.groupBy("video").agg(F.count(F.lit(1)).alias("_n_urls"))
    cuts = kept(
        n_tasks.join(n_urls, "video")
        .withColumn("_entity_parts", F.ceil(F.col("_n_urls") / cell_entities))
        .withColumn("_task_parts", F.ceil(F.col("_n_tasks") / cell_tasks))
    )
    sent = cuts.agg(
        F.sum(F.col("_n_urls") * F.col("_task_parts")).alias("urls"),
        F.sum(F.col("_n_tasks") * F.col("_entity_parts")).alias("tasks"),
    ).first()
    cells = max(1, math.ceil(max((sent.urls or 0) / cell_entities, (sent.tasks or 0) / cell_tasks)))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))

    cell = F.concat_ws("|", "_entity_part", "_task_part", "video").alias("_cell")
    # Numbered entities already lie by video; a merge join moves only the counts.
    lists = (
        urls.hint("merge")
        .join(cuts, "video")
        .withColumn("_entity_part", F.pmod(F.xxhash64("url"), "_entity_parts"))
        .withColumn("_task_part", every("_task_parts"))
        .select(cell, "url")
        .repartition(cells, "_cell")
        .groupBy("_cell")
        .agg(F.collect_list(F.struct("url")).alias("_urls"))
        .select("_cell", F.explode(_slices(F.col("_urls"), LIST_URLS)).alias("_urls"))
    )
    met = (
        asked.join(cuts, "video")
        .withColumn("_task_part", F.pmod(F.xxhash64("task"), "_task_parts"))
        .withColumn("_entity_part", every("_entity_parts"))
        .select(cell, *tasks.columns)
        .repartition(cells, "_cell")
    )
    # A merge join reads the lists once, in order, and keeps the tasks of one cell at hand.
    messages = lists.hint("merge").join(met, "_cell").withColumn("_url", F.explode("_urls"))
    others = [c for c in tasks.columns if c != "video"]
    return messages.select("video", *others, F.col("_url.url").alias("url"))


def _slices(items: Column, size: int) -> Column:
    """An array cut into arrays of ``size`` items; the last may be shorter."""
    starts = F.sequence(F.lit(1), F.size(items), F.lit(size))
    return F.transform(starts, lambda start: F.slice(items, start, F.lit(size)))


def serial_fan_out(tasks: DataFrame, stored: DataFrame) -> DataFrame:
    """The one stored entity named by the command's serial, for the commands that start on it."""
    return tasks.where(F.col("input") == "serial").join(
        stored.select("video", "serial", "url"), ["video", "serial"]
    )


def plan_edges(tasks: DataFrame) -> DataFrame:
    """Edges of every task's plan. The edge table is a constant of a few dozen rows."""
    return tasks.select("task", "command").join(F.broadcast(edge_table(tasks.sparkSession)), "command")


def plan_nodes(tasks: DataFrame) -> DataFrame:
    """Nodes of every task's plan, none executed yet."""
    return (
        tasks.select("task", "command")
        .join(F.broadcast(node_table(tasks.sparkSession)), "command")
        .withColumn("executed", F.lit(False))
    )


def entry_ports(tasks: DataFrame) -> DataFrame:
    """Messages that start the tasks, addressed to their plans' entry ports."""
    return tasks.join(
        F.broadcast(
            entry_table(tasks.sparkSession).groupBy("command").agg(F.sort_array(F.collect_list("port")).alias("dest_ports"))
        ),
        "command",
    )
