"""Registered queries: every operator over whole tables of one folder."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions import names as N
from sightline.functions import payload as P
from sightline.functions import vectors as V
from sightline.operators import aggregates as G
from sightline.operators import entities as E
from sightline.operators import joins as J
from sightline.operators import ranking as W
from sightline.operators import intervals, packs, pairs, pivots, reports, routing, scoring, similarity, timetree
from sightline.operators import sequences as S
from sightline.plans import commands as C
from sightline.plans import flow
from sightline.plans.tables import TOPIC_OF, Tables
from sightline.schema import ATTRS

HOUR_MS = 3_600_000
SCORES = ("s1", "s2", "s3")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]):
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(spark, folder))

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _kept(t: Tables, samples: int = 3) -> DataFrame:
    """Boxes that keep their pixels and have an area."""
    return S.kept_samples(S.clear_unsampled(t.patched_boxes(), samples))


def _means(t: Tables) -> DataFrame:
    boxes = S.uniform_sample(t.boxes(), 3).where("kept")
    return G.mean_scores(boxes, SCORES)


# ---- flagship ------------------------------------------------------------


@query
def bucket_scores(t: Tables) -> DataFrame:
    """Score bands of the sampled boxes' entities per time bucket."""
    edges = timetree.time_bucket_join(t.entities(), t.time_buckets(), keys=("entity",))
    placed = edges.join(_means(t), "entity")
    return placed.groupBy("bucket_start", F.floor("s1").alias("band")).agg(
        F.count(F.lit(1)).alias("n_entities"), F.sum("n_samples").alias("n_samples")
    )


# ---- sources and sinks ---------------------------------------------------


@query
def store_split(t: Tables) -> DataFrame:
    kept = S.clear_unsampled(t.patched_boxes(), 3).where(F.col("patch").isNotNull())
    return kept.select("entity", "idx", "x", "y", "w", "h", P.to_base64(F.col("patch")).alias("data"))


@query
def load_join(t: Tables) -> DataFrame:
    samples = S.clear_unsampled(t.patched_boxes(), 3).where(F.col("patch").isNotNull())
    boxes = t.boxes().select("entity", "idx", "x", "y", "w", "h")
    loaded = J.load_join(boxes, samples)
    return loaded.select(
        "entity",
        "idx",
        "w",
        "h",
        F.col("patch").isNotNull().alias("sampled"),
        F.coalesce(F.col("patch").cast("string"), F.lit("")).alias("patch"),
    )


@query
def oversize_route(t: Tables) -> DataFrame:
    url = F.concat(F.lit("/meta/documents/"), F.col("doc_id"))
    routed = routing.by_reference(t.read("documents").select("doc_id", "text"), "text", url, limit=2000)
    return routed.select(
        "doc_id",
        F.col("n_bytes").cast("bigint").alias("n_bytes"),
        "stored",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.md5("text"), F.lit("")).alias("inline_digest"),
    )


@query
def save_new_only(t: Tables) -> DataFrame:
    incoming = t.read("lineitem").select(F.col("l_orderkey").alias("entity"), (F.col("l_orderkey") % 500).alias("task"))
    stored = t.entities().where(F.col("status") == "F")
    archived = t.events().where(F.col("event_type") == "error").select(F.col("user_id").alias("task"))
    return J.drop_stored(incoming, stored, ["entity"], archived)


@query
def first_sample(t: Tables) -> DataFrame:
    first = S.first_sample(S.clear_unsampled(t.patched_boxes(), 3))
    return first.select("entity", "idx", F.col("patch").cast("string").alias("patch"))


# ---- scalar functions ----------------------------------------------------


@query
def parse_video(t: Tables) -> DataFrame:
    v = F.col("video")
    return t.entities().select(
        "entity",
        N.video_part(v, "camera").alias("cam"),
        N.video_part(v, "start").alias("video_start"),
        N.video_part(v, "end").alias("video_end"),
        "entity_id",
    )


@query
def start_time(t: Tables) -> DataFrame:
    start, frame = F.col("video_start"), F.col("start_frame")
    return t.entities().select(
        "entity", "start_frame", N.start_time(start, frame).alias("start_time"),
        N.start_time(start, frame, compat=True).alias("start_time_compat"),
    )


@query
def video_path(t: Tables) -> DataFrame:
    path = N.video_path(F.lit("/videos"), F.col("video"))
    store = N.store_path(
        F.lit("/meta/"), F.lit("ssd"), F.lit("2018-05-09"), F.col("video"), F.lit("task"), F.col("entity")
    )
    return t.entities().select(
        "entity", path.alias("path"), N.file_stem(path).alias("stem"), store.alias("store_path")
    )


@query
def json_header(t: Tables) -> DataFrame:
    header = F.concat(
        F.lit('{"id":{"video-url":"'), F.col("video"),
        F.lit('","serial-number":'), F.col("entity"),
        F.lit('},"tracklet-number":1,"run-frame-index":'), F.col("start_frame"),
        F.lit(',"bounding-boxes":[{"x":'), F.col("entity") % 640,
        F.lit(',"y":2,"width":3,"height":4}]}'),
    )
    fields = P.header_fields(F.col("header"))
    typed = P.parse_header(F.col("header"))
    return t.entities().select("entity", "video", "start_frame", header.alias("header")).select(
        "entity",
        fields["video"].alias("video"),
        fields["start_frame"].cast("bigint").alias("start_frame"),
        fields["boxes_json"].alias("boxes_json"),
        typed["id"]["serial-number"].cast("bigint").alias("serial"),
        F.get(typed["bounding-boxes"], F.lit(0))["x"].cast("bigint").alias("first_x"),
    )


@query
def feature_codec(t: Tables) -> DataFrame:
    coded = t.features().withColumn("text", V.encode_feature(F.col("vec"))).withColumn(
        "back", V.decode_feature(F.col("text"))
    )
    return coded.select(
        "id",
        F.octet_length(F.unbase64("text")).cast("bigint").alias("n_bytes"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.size("back").cast("bigint").alias("n_floats"),
        F.get("back", F.lit(0)).cast("double").alias("first"),
        F.element_at("back", -1).cast("double").alias("last"),
        (F.col("back") == F.col("vec")).alias("same"),
    )


@query
def scores_to_map(t: Tables) -> DataFrame:
    # The features have fewer elements than there are scores, so they are read around.
    scores = F.transform(
        F.sequence(F.lit(0), F.lit(95)), lambda i: F.get(F.col("vec"), i % F.size("vec"))
    )
    return t.features().withColumn("scores", scores).select("id", *P.score_columns(F.col("scores")))


@query
def time_keys(t: Tables) -> DataFrame:
    keyed = timetree.with_time_keys(t.entities())
    return keyed.select("entity", *[f"{level}_key" for level in timetree.LEVELS])


# ---- sequences -----------------------------------------------------------


@query
def uniform_sample(t: Tables) -> DataFrame:
    two = S.uniform_sample(t.boxes(), 2, flag="kept_2")
    return S.uniform_sample(two, 3, flag="kept_3").select("entity", "idx", "n", "kept_2", "kept_3")


@query
def kept_samples(t: Tables) -> DataFrame:
    return _kept(t).select("entity", "idx", "w", "h")


@query
def mean_scores(t: Tables) -> DataFrame:
    return _means(t)


@query
def approx_equal(t: Tables) -> DataFrame:
    """Whether the sampled boxes have the same mean scores as all boxes."""
    vec = F.array(*SCORES)
    sampled = _means(t).select("entity", vec.alias("a"))
    everything = G.mean_scores(t.boxes(), SCORES).select("entity", vec.alias("b"))
    return sampled.join(everything, "entity").select("entity", V.approx_equal(F.col("a"), F.col("b")).alias("same"))


@query
def fragment_chunks(t: Tables) -> DataFrame:
    chunks = S.fragment_chunks(t.boxes(), size=3, keys=("entity",), item="x")
    return chunks.withColumn("x", F.array_join(F.col("x").cast("array<string>"), ","))


@query
def serial_number(t: Tables) -> DataFrame:
    return t.numbered_entities().select("video", "entity", "serial", "num")


# ---- routing -------------------------------------------------------------


@query
def topic_split(t: Tables) -> DataFrame:
    body = T.StructType([T.StructField("k", T.LongType())])
    split = routing.topic_split(t.messages(), {topic: body for topic in TOPIC_OF.values()})
    parts = [
        df.groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"), F.sum("payload.k").alias("sum_k"))
        for df in split.values()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def port_filter(t: Tables) -> DataFrame:
    arrived = routing.for_port(t.messages("TRACKLET"), "pedestrian-tracklet-saving")
    return routing.complete_outputs(arrived, ["user_plan", "task", "dest_ports"]).select(
        "event_id", "task", "user_plan"
    )


@query
def drop_cancelled(t: Tables) -> DataFrame:
    others = [topic for topic in TOPIC_OF.values() if topic != "TERM_SIG"]
    kept = routing.drop_cancelled(t.messages(*others), t.messages("TERM_SIG"))
    return kept.select("event_id", "task", "topic")


@query
def recent_signals(t: Tables) -> DataFrame:
    return W.recent_signals(t.messages("TERM_SIG"))


@query
def command_check(t: Tables) -> DataFrame:
    return C.check_commands(t.commands()).select("command_id", "command", "status")


# ---- commands and plans --------------------------------------------------


@query
def task_fanout(t: Tables) -> DataFrame:
    return C.fan_out(t.commands(), t.files()).select("command_id", "command", "path", "task")


@query
def entity_fanout(t: Tables) -> DataFrame:
    tasks = C.fan_out(t.commands(), t.files())
    return C.entity_fan_out(tasks, t.stored_entities()).select("command_id", "task", "video", "url")


@query
def serial_fanout(t: Tables) -> DataFrame:
    tasks = C.fan_out(t.commands().withColumn("serial", F.col("serial") % 4), t.files())
    return C.serial_fan_out(tasks, t.stored_entities()).select("command_id", "task", "video", "url")


@query
def plan_edges(t: Tables) -> DataFrame:
    return C.plan_edges(C.fan_out(t.commands(), t.files())).select("task", "src", "dst", "output_type", "port")


@query
def entry_ports(t: Tables) -> DataFrame:
    tasks = C.entry_ports(C.fan_out(t.commands(), t.files()))
    return tasks.select("task", F.array_join("dest_ports", ",").alias("ports"))


@query
def plan_merge(t: Tables) -> DataFrame:
    nodes = t.messages("TRACKLET", "ATTRIBUTES").select(
        F.concat("task", F.lit("-"), "serial").alias("plan"),
        "k",
        F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(4)])).alias("node"),
    )
    ran = F.col("k") % (F.col("node") * 10 + 11) == 0
    return G.merge_executed(nodes.withColumn("executed", ran))


# ---- joins ---------------------------------------------------------------


def _sides(t: Tables):
    return t.side("TRACKLET", "left"), t.side("ATTRIBUTES", "right")


@query
def full_outer_split(t: Tables) -> DataFrame:
    left, right = _sides(t)
    left = left.withColumn("batch", J.batch_of(F.col("left_ts"), 6 * HOUR_MS))
    right = right.withColumn("batch", J.batch_of(F.col("right_ts"), 6 * HOUR_MS))
    sides = J.full_outer_sides(left, right, ["task", "serial", "batch"])
    none = F.lit(-1).cast("bigint")
    return sides.select(
        "task",
        "serial",
        "batch",
        "side",
        F.coalesce("left_id", none).alias("left_id"),
        F.coalesce("right_id", none).alias("right_id"),
    )


@query
def buffered_join(t: Tables) -> DataFrame:
    left, right = _sides(t)
    pairs = J.buffered_join(left, right, ["task", "serial"], buffer_ms=6 * HOUR_MS, how="left_outer")
    return pairs.select("task", "serial", "left_id", F.coalesce("right_id", F.lit(-1).cast("bigint")).alias("right_id"))


def _pairs(t: Tables) -> DataFrame:
    left, right = _sides(t)
    return J.consume_join(left, right, ["task", "serial"], batch_ms=HOUR_MS, buffer_ms=24 * HOUR_MS)


@query
def consume_join(t: Tables) -> DataFrame:
    return _pairs(t).select("task", "serial", "left_id", "right_id", "how")


@query
def joined_union(t: Tables) -> DataFrame:
    pairs = _pairs(t).withColumns({
        "executed": (F.col("left_k") % 2 == 1) | (F.col("right_k") % 3 == 1),
        "user_plan": F.col("left_plan"),
    })
    ready = t.messages("TRACKLET_ATTR").select(
        "task",
        "serial",
        F.col("event_id").alias("left_id"),
        F.col("event_id").alias("right_id"),
        (F.col("k") % 2 == 1).alias("executed"),
        "user_plan",
    )
    columns = ["task", "serial", "left_id", "right_id", "executed", "user_plan"]
    union = J.joined_union(pairs.select(*columns, "how"), ready.select(*columns))
    return union.withColumn("user_plan", F.coalesce("user_plan", F.lit("")))


@query
def valid_edges(t: Tables) -> DataFrame:
    return J.valid_edges(t.links(), t.features(), ["at", "o1", "o2", "o3"])


@query
def pid_join(t: Tables) -> DataFrame:
    joined = J.pid_join(t.containers(), t.processes())
    return joined.select(
        "container",
        "node",
        "pid",
        F.array_join(F.col("index_list").cast("array<string>"), ",").alias("index_list"),
        F.array_join(F.col("mem_list").cast("array<string>"), ",").alias("mem_list"),
    )


@query
def time_bucket_join(t: Tables) -> DataFrame:
    return timetree.time_bucket_join(t.entities(), t.time_buckets(), keys=("entity_id", "data_type"))


@query
def span_edges(t: Tables) -> DataFrame:
    return timetree.span_edges(t.entities(), t.spans(), keys=("entity", "data_type"))


@query
def video_overlaps(t: Tables) -> DataFrame:
    """Videos of two cameras that share a moment."""

    def spans(mark: str) -> DataFrame:
        def at(part: str):
            return F.unix_timestamp(N.video_part(F.col("video"), part), N.PACKED)

        return t.videos().select(
            F.col("video").alias(mark), at("start").alias(f"{mark}_start"), at("end").alias(f"{mark}_end")
        )

    met = intervals.interval_join(spans("a"), spans("b"), ("a_start", "a_end"), ("b_start", "b_end"))
    shared = F.least("a_end", "b_end") - F.greatest("a_start", "b_start")
    return met.where(F.col("a") < F.col("b")).select("a", "b", shared.alias("shared_s"))


@query
def bucket_counts(t: Tables) -> DataFrame:
    return timetree.bucket_counts(
        timetree.time_bucket_join(t.entities(), t.time_buckets(), keys=("entity_id", "data_type"))
    )


# ---- aggregates ----------------------------------------------------------


def _stored(t: Tables) -> DataFrame:
    """Entities that have boxes, as members of their video's task."""
    with_boxes = t.read("lineitem").select(F.col("l_orderkey").alias("entity")).distinct()
    return t.numbered_entities().join(with_boxes, "entity", "left_semi").withColumn("task", F.col("video"))


@query
def complete_groups(t: Tables) -> DataFrame:
    return G.complete_groups(_stored(t))


@query
def repath_complete(t: Tables) -> DataFrame:
    stored = _stored(t)
    root = F.concat(F.lit("/meta/result/"), F.col("video"))
    moved = E.repath_complete(stored, G.complete_groups(stored), root)
    return moved.select("entity", "path")


@query
def archived_entities(t: Tables) -> DataFrame:
    """All stored entities after the archive paths of complete tasks were merged into them."""
    stored = _stored(t)
    root = F.concat(F.lit("/meta/result/"), F.col("video"))
    path = F.concat(root, F.lit("/"), F.col("task"), F.lit("/"), F.col("serial").cast("string"))
    track = E.as_group(stored.withColumn("path", path), "track", ["path", "start_time"], F.lit(1))
    archive = E.archive_updates(stored, G.complete_groups(stored), root, F.lit(2))
    merged = E.merge_groups([track, archive], ["track", "archive"])
    return merged.select("entity_id", "data_type", E.current_path().alias("path"), "track.start_time")


@query
def topic_counts(t: Tables) -> DataFrame:
    counts = G.topic_counts(t.messages())
    return counts.select(
        F.coalesce("topic", F.lit("all")).alias("topic"),
        F.coalesce("partition", F.lit(-1).cast("bigint")).alias("partition"),
        "n_messages",
    )


@query
def mean_cost(t: Tables) -> DataFrame:
    return G.mean_cost(t.run_log())


def _since():
    return F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")


@query
def distinct_since(t: Tables) -> DataFrame:
    return G.distinct_since(t.run_log(), _since())


@query
def runs_since(t: Tables) -> DataFrame:
    return G.runs_since(t.run_log(), _since()).select("event_id", "task", "type", "node", "video")


@query
def video_duration(t: Tables) -> DataFrame:
    return G.video_duration(t.run_log().select("video").distinct())


@query
def total_duration(t: Tables) -> DataFrame:
    return G.total_duration(t.run_log().select("video").distinct())


@query
def link_count(t: Tables) -> DataFrame:
    return W.link_counts(J.valid_edges(t.links(), t.features(), ["at", "o1", "o2", "o3"]))


# ---- ranking -------------------------------------------------------------


@query
def latest_per_node(t: Tables) -> DataFrame:
    return reports.latest_per_node(t.device_reports(), ["ts", "event_id"]).select("node", "event_id", "pid", "util")


@query
def ranked_links(t: Tables) -> DataFrame:
    last = J.valid_edges(t.links(), t.features(), ["at", "o1", "o2", "o3"])
    return W.ranked_links(last, hot_rows=t.hot_rows, probe=t.links())


@query
def topk_similar(t: Tables) -> DataFrame:
    top = similarity.topk_similar(t.features(), t.features(), k=10)
    return top.select("probe", "rank", "id", F.round("sim", 6).alias("sim"))


@query
def topk_pruned(t: Tables) -> DataFrame:
    """The nearest features by a gallery that keeps its angles to a few pivots."""
    chosen = pivots.choose_pivots(t.features())
    indexed = pivots.clustered(pivots.with_pivots(t.features(), chosen))
    top = pivots.topk_pruned(t.features(), indexed, chosen, k=10)
    return top.select("probe", "rank", "id", F.round("sim", 6).alias("sim"))


@query
def id_ranks(t: Tables) -> DataFrame:
    lists = similarity.rank_lists(similarity.topk_similar(t.features(), t.features(), k=10))
    return lists.select("probe", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


# ---- sets, upserts, lookups, similarity ----------------------------------


@query
def free_devices(t: Tables) -> DataFrame:
    devices = t.device_reports().select("node", "device")
    busy = t.device_reports().where(F.col("util") > 190.0)
    return reports.free_devices(devices, busy)


GROUPS = ("track", "attr", "feature")


def _entity_table(t: Tables) -> DataFrame:
    """Entities after their tracking, scoring and feature updates."""
    entities = t.entities().select(
        F.col("entity").cast("string").alias("entity_id"), "data_type", "video", "start_time", "start_frame", "status",
        F.concat(F.lit("/meta/"), "entity_id").alias("path"),
    )
    track = ["path", "start_time", "start_frame", "video"]
    first = E.as_group(entities.where(F.col("status") != "P"), "track", track, F.lit(1))
    moved = entities.where(F.col("status") == "F").withColumn("path", F.concat("path", F.lit(".har")))
    again = E.as_group(moved, "track", track, F.lit(4))
    plan = lambda key: F.concat(F.lit("plan-"), key % 3)
    attrs = _means(t).select(
        F.col("entity").cast("string").alias("entity_id"), plan(F.col("entity")).alias("data_type"), *SCORES
    )
    features = E.feature_update(t.features()).select(
        F.col("id").cast("string").alias("entity_id"),
        plan(F.col("id")).alias("data_type"),
        F.size("vec").alias("n_floats"),
        "is_finish",
        "is_get_sim",
    )
    parts = [
        first,
        E.as_group(attrs, "attr", SCORES, F.lit(2)),
        E.as_group(features, "feature", ["n_floats", "is_finish", "is_get_sim"], F.lit(3)),
        again,
    ]
    return E.flatten_groups(E.merge_groups(parts, GROUPS), GROUPS)


@query
def upsert_merge(t: Tables) -> DataFrame:
    none = F.lit(-1.0)
    return _entity_table(t).select(
        "entity_id",
        "data_type",
        F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("start_time", F.lit("")).alias("start_time"),
        *[F.coalesce(s, none).alias(s) for s in SCORES],
        F.coalesce("n_floats", F.lit(0)).cast("bigint").alias("n_floats"),
        F.coalesce("is_finish", F.lit(False)).alias("is_finish"),
        F.coalesce("is_get_sim", F.lit(True)).alias("is_get_sim"),
    )


@query
def lookup_entity(t: Tables) -> DataFrame:
    probes = t.events().select(
        F.col("user_id").cast("string").alias("entity_id"), F.concat(F.lit("plan-"), F.col("k") % 3).alias("data_type")
    )
    found = E.lookup(_entity_table(t), probes, ["path", *SCORES])
    return found.select(
        "entity_id",
        "data_type",
        F.coalesce("path", F.lit("")).alias("path"),
        *[F.coalesce(s, F.lit(-1.0)).alias(s) for s in SCORES],
    )


@query
def lookup_feature(t: Tables) -> DataFrame:
    """Stored features of the probed entities, decoded."""
    stored = t.features().select(
        F.col("id").cast("string").alias("entity_id"),
        F.concat(F.lit("plan-"), F.col("id") % 3).alias("data_type"),
        V.encode_feature(F.col("vec")).alias("reid_feature"),
    )
    probes = t.events().select(
        F.col("user_id").cast("string").alias("entity_id"), F.concat(F.lit("plan-"), F.col("k") % 3).alias("data_type")
    )
    found = E.lookup_feature(stored, probes)
    first, last = (F.element_at("vec", i).cast("double") for i in (1, -1))
    return found.select(*E.KEYS, F.size("vec").cast("bigint").alias("n_floats"), first.alias("first"), last.alias("last"))


@query
def pair_value(t: Tables) -> DataFrame:
    last = J.valid_edges(t.links(), t.features(), ["at", "o1", "o2", "o3"])
    probes = t.read("lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")
    )
    return E.pair_value(last, probes)


@query
def pair_similarity(t: Tables) -> DataFrame:
    pairs = J.valid_edges(t.links(), t.features(), ["at", "o1", "o2", "o3"]).select("src", "dst")
    scored = similarity.pair_similarity(pairs, t.features())
    return scored.select(
        "src", "dst", F.round("similarity", 6).alias("similarity"), F.round("dissimilarity", 6).alias("dissimilarity")
    )


@query
def sim_by_bucket(t: Tables) -> DataFrame:
    events = t.events()
    times = events.select(F.col("event_id").alias("id"), F.date_format("ts", "yyyyMMddHHmmss").alias("start_time"))
    pairs = events.select(
        F.col("event_id").alias("src"),
        (F.col("event_id") + 1 + F.col("k") % 3).alias("dst"),
        F.col("value").alias("sim"),
    )
    return similarity.sim_by_bucket(pairs, times).select("src", "dst", "sim", "level")


@query
def pairs_in_bucket(t: Tables) -> DataFrame:
    """The five most similar features among those of entities that start in one month."""
    month = t.entities().select(F.col("entity").alias("id"), N.time_key(F.col("start_time"), "month").alias("bucket"))
    found = pairs.pairs_in_bucket(t.features().join(month, "id"), k=5, hot_rows=t.hot_rows)
    return found.withColumn("sim", F.round("sim", 6))


@query
def attr_distance(t: Tables) -> DataFrame:
    pairs = t.links().select("src", "dst").distinct()
    scores = _means(t).withColumnRenamed("entity", "id")
    return similarity.attr_distance(pairs, scores, SCORES)


# ---- scoring hook --------------------------------------------------------


@query
def scores_hook(t: Tables) -> DataFrame:
    """Attributes of every entity from a stand-in model over its sampled boxes."""
    names = list(ATTRS)
    boxes = _kept(t).select("entity", "idx", "x", "y", "w", "h")
    means = scoring.mean_vectors(
        boxes, scoring.stand_in_recognizer(names), names, ["entity"], "stand-in-125", t.hot_rows,
        t.read("lineitem").select(F.col("l_orderkey").alias("entity")),
    )
    return means.select("entity", "n_samples", *[F.get("scores", F.lit(i)).alias(n) for i, n in enumerate(names)])


@query
def tracks_hook(t: Tables) -> DataFrame:
    """Entities of every video from a stand-in tracker: one row in, many out."""
    return scoring.score_batches(t.videos(), scoring.stand_in_tracker(), scoring.TRACKS, "stand-in-tracker")


@query
def features_hook(t: Tables) -> DataFrame:
    """A feature of every sampled box from a stand-in network."""
    boxes = _kept(t).select("entity", "idx", "x", "y", "w", "h")
    schema = "entity long, idx long, vec array<float>"
    made = scoring.score_batches(boxes, scoring.stand_in_extracter(), schema, "stand-in-128")
    return made.select(
        "entity",
        "idx",
        F.size("vec").cast("bigint").alias("n_floats"),
        F.get("vec", F.lit(0)).cast("double").alias("first"),
        F.element_at("vec", -1).cast("double").alias("last"),
    )


@query
def detections_hook(t: Tables) -> DataFrame:
    """A label and boxes of every image from a stand-in detector."""
    image = t.entities().select(
        F.col("entity").alias("id"),
        (64 + F.col("entity") % 50).alias("width"),
        (48 + F.col("start_frame") % 30).alias("height"),
    )
    found = scoring.score_batches(image, scoring.stand_in_detector(), scoring.DETECTIONS, "stand-in-detector")
    first = F.get("boxes", F.lit(0))
    return found.select(
        "id", "label", F.size("boxes").cast("bigint").alias("n_boxes"), first["x"].alias("x"), first["y"].alias("y"), first["score"].alias("score")
    )


def _tracked_boxes(videos: DataFrame) -> DataFrame:
    """Stand-in tracker whose entities carry their boxes."""
    found = scoring.score_batches(videos, scoring.stand_in_tracker(), scoring.TRACKS, "stand-in-tracker")
    place = lambda i: F.struct(
        i.alias("x"), (i * 2).alias("y"), F.lit(3).alias("w"), (i + 1).alias("h"), F.lit(b"p").alias("patch")
    )
    positions = F.sequence(F.lit(0).cast("bigint"), F.col("n_boxes") - 1)
    return found.withColumn("boxes", F.transform(positions, place)).drop("n_boxes")


@query
def command_flow(t: Tables) -> DataFrame:
    """What all commands store: tracks, attributes, features and ranks along the edges of their plans."""
    names, keys = list(ATTRS), ("origin", *flow.ENTITY)
    models = flow.Models(
        tracker=_tracked_boxes,
        recognizer=scoring.stand_in_recognizer(names, keys),
        extracter=scoring.stand_in_extracter(keys=keys),
        reider=scoring.stand_in_reider(names, keys),
        names=names,
        label="stand-in-flow",
    )
    owner = t.numbered_entities().select("entity", "video", "serial")
    boxes = t.patched_boxes().join(owner, "entity")
    # What was stored before: the mean score s1 of the entity, plus the attribute's number.
    old = [(F.col("s1") + i).alias(n) for i, n in enumerate(names)]
    attrs = _means(t).join(owner, "entity").select("video", "serial", *old)
    updates = flow.entity_updates(t.commands(), t.files(), models, boxes, attrs, date="2018-05-09", lie_by=["entity"])
    stored = E.merge_groups([updates], ["track", "attr", "feature", "rank"])
    vec = V.decode_feature(F.col("feature.reid_feature"))
    return stored.select(
        *E.KEYS,
        F.coalesce("track.path", F.lit("")).alias("path"),
        F.coalesce("track.start_time", F.lit("")).alias("start_time"),
        F.coalesce("track.num", F.lit(-1)).cast("bigint").alias("num"),
        *[F.coalesce(f"attr.{n}", F.lit(-1.0)).alias(n) for n in names],
        F.coalesce(F.get(vec, F.lit(0)).cast("double"), F.lit(-1.0)).alias("feature_first"),
        F.coalesce(F.get(vec, F.lit(127)).cast("double"), F.lit(-1.0)).alias("feature_last"),
        F.coalesce("feature.is_finish", F.lit(False)).alias("is_finish"),
        F.coalesce(F.array_join(F.col("rank.ids").cast("array<string>"), ","), F.lit("")).alias("ids"),
    )


@query
def pack_files(t: Tables) -> DataFrame:
    """Where the pixels of every box lie in the packs of its video."""
    owner = t.numbered_entities().select("entity", "video", "serial")
    member = F.concat_ws("/", "serial", "idx").alias("member")
    files = t.patched_boxes().join(owner, "entity").select("video", member, F.octet_length("patch").alias("length"))
    planned = packs.plan_packs(files, ["video"], target=4096, cell_packs=16)
    return planned.select("video", "member", "length", "pack", F.col("offset").alias("at"))
