"""Logical tables of the domain, read from the given parquet tables.

``events`` play the messages, run log and device reports; ``orders`` the
entities and their videos; ``lineitem`` the boxes and the links;
``embeddings`` the features; ``customer`` the containers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.names import entity_id, start_time, store_path, video_path
from sightline.operators.ranking import HOT_ROWS, number_rows
from sightline.plans.commands import COMMANDS, NOT_IMPLEMENTED
from sightline.schema import PORTS
from sightline.session import pin_time_zone

TOPIC_OF = {
    "click": "TRACKLET",
    "purchase": "ATTRIBUTES",
    "error": "TERM_SIG",
    "signup": "COMMAND",
    "view": "TRACKLET_ATTR",
}

RUN_TYPE = {"click": "tracking", "purchase": "attr", "view": "reid", "error": "detection", "signup": "faster"}

COMMAND_NAMES = [*COMMANDS, *NOT_IMPLEMENTED, "no-such-command"]

NAME_FORMAT = "yyyyMMddHHmmss"


def _lookup(column, mapping: dict[str, str]):
    out = None
    for key, value in mapping.items():
        hit = column == key
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


class Tables:
    """The logical tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str, hot_rows: int = HOT_ROWS):
        self.spark = pin_time_zone(spark)
        self.folder = folder
        self.hot_rows = hot_rows
        self._known: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        """The same frame for every use in a query, so that footers and skew are read once."""
        if name not in self._known:
            self._known[name] = build()
        return self._known[name]

    def read(self, name: str) -> DataFrame:
        return self._once(name, lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def events(self) -> DataFrame:
        k = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0))
        return self.read("events").withColumn("k", k)

    def messages(self, *topics: str) -> DataFrame:
        """All messages, or those of some topics; the filter is on a stored column and reaches the scan."""
        events = self.events()
        if topics:
            events = events.where(F.col("event_type").isin([e for e, t in TOPIC_OF.items() if t in topics]))
        topic = _lookup(F.col("event_type"), TOPIC_OF)
        by_topic = {t: [p for p, read in PORTS.items() if read == t] for t in TOPIC_OF.values()}
        ports = None
        for t, names in by_topic.items():
            ports_of = F.array(*[F.lit(n) for n in names]) if names else F.expr("cast(array() as array<string>)")
            ports = F.when(topic == t, ports_of) if ports is None else ports.when(topic == t, ports_of)
        addressed = F.filter(ports, lambda p, i: F.call_function("shiftright", F.col("k"), i) % 2 == 1)
        return events.select(
            "event_id",
            "ts",
            F.col("user_id").cast("string").alias("task"),
            topic.alias("topic"),
            (F.col("event_id") % 6).alias("partition"),
            (F.col("k") % 2).alias("serial"),
            "k",
            "value",
            F.col("props").alias("payload"),
            F.when(F.col("k") % 5 != 0, F.concat(F.lit("plan-"), F.col("k") % 7)).alias("user_plan"),
            addressed.alias("dest_ports"),
        )

    def side(self, topic: str, name: str) -> DataFrame:
        """Messages of one topic as one side of a join."""
        return self.messages(topic).select(
            "task",
            "serial",
            F.col("event_id").alias(f"{name}_id"),
            F.col("ts").alias(f"{name}_ts"),
            F.col("k").alias(f"{name}_k"),
            F.col("user_plan").alias(f"{name}_plan"),
        )

    def commands(self) -> DataFrame:
        names = F.array(*[F.lit(c) for c in COMMAND_NAMES])
        cam = F.concat(F.lit("/videos/CAM0"), F.col("event_id") % 6 + 1)
        week = F.date_add(F.lit("1994-12-26").cast("date"), (F.col("event_id") % 344 * 7).cast("int"))
        day = F.concat_ws("/", cam, F.date_format(week, "yyyy-MM-dd"))
        return self.messages("COMMAND").select(
            F.col("event_id").alias("command_id"),
            F.get(names, F.col("event_id") % len(COMMAND_NAMES)).alias("command"),
            F.when(F.col("event_id") % 97 == 0, F.concat(cam, F.lit("/"))).otherwise(day).alias("target"),
            F.col("k").alias("serial"),
        )

    def entities(self) -> DataFrame:
        start = F.date_trunc("week", F.col("o_orderdate")) + F.make_dt_interval(hours=F.col("o_custkey").cast("int") % 4 * 6)
        begin = F.date_format(start, NAME_FORMAT)
        video = F.concat_ws(
            "-",
            F.concat(F.lit("CAM0"), F.col("o_custkey") % 6 + 1),
            begin,
            F.date_format(start + F.make_dt_interval(hours=F.lit(6)), NAME_FORMAT),
        )
        frame = F.col("o_orderkey") * 37 % 1_000_000
        return self.read("orders").select(
            F.col("o_orderkey").alias("entity"),
            video.alias("video"),
            begin.alias("video_start"),
            frame.alias("start_frame"),
            start_time(begin, frame).alias("start_time"),
            entity_id(video, F.col("o_orderkey")).alias("entity_id"),
            F.concat(F.lit("plan-"), F.col("o_orderkey") % 3).alias("data_type"),
            F.col("o_orderstatus").alias("status"),
        )

    def numbered_entities(self) -> DataFrame:
        """Entities with their serial number in the video and the number declared for it."""
        return self._once(
            "_numbered",
            lambda: number_rows(
                self.entities(), ["video"], [F.asc("entity")], index="serial", total="num", hot_rows=self.hot_rows
            ),
        )

    def stored_entities(self) -> DataFrame:
        url = store_path(
            F.lit("/meta/"), F.lit("ssd"), F.lit("2018-05-09"), F.col("video"), F.lit("task"), F.col("serial")
        )
        return self.numbered_entities().select("video", "serial", url.alias("url"), "entity")

    def videos(self) -> DataFrame:
        return self.entities().select("video").distinct()

    def files(self) -> DataFrame:
        return self.videos().select(video_path(F.lit("/videos"), F.col("video")).alias("path"))

    def boxes(self) -> DataFrame:
        """Boxes with their position and the length of the sequence."""
        hundredths = lambda c: F.round(F.col(c) * 100)
        raw = self.read("lineitem").select(
            F.col("l_orderkey").alias("entity"),
            (F.col("l_quantity").cast("bigint") - 1).alias("w"),
            (F.col("l_linenumber").cast("bigint") * 10).alias("h"),
            hundredths("l_discount").alias("s1"),
            hundredths("l_tax").alias("s2"),
            F.col("l_quantity").alias("s3"),
            F.col("l_partkey").alias("_a"),
            F.col("l_suppkey").alias("_b"),
        )
        order = [F.asc(c) for c in ("h", "_a", "_b", "w", "s1", "s2")]
        # Places follow from the order's columns, so they are made behind its shuffle.
        place = [(F.col("_a") % 640).alias("x"), (F.col("_b") % 480).alias("y")]
        rest = ["w", "h", "s1", "s2", "s3", "idx", "n"]
        return self._once(
            "_boxes",
            lambda: number_rows(raw, ["entity"], order, total="n", hot_rows=self.hot_rows).select("entity", *place, *rest),
        )

    def patched_boxes(self) -> DataFrame:
        """Boxes whose pixels are a text made of their place."""
        place = F.concat_ws(":", "entity", "idx", "x", "y")
        return self.boxes().withColumn("patch", place.cast("binary"))

    def features(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))

    def links(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_partkey").alias("src"),
            F.col("l_suppkey").alias("dst"),
            F.col("l_discount").alias("sim"),
            F.col("l_shipdate").alias("at"),
            F.col("l_orderkey").alias("o1"),
            F.col("l_linenumber").alias("o2"),
            F.col("l_extendedprice").alias("o3"),
        )

    def time_buckets(self) -> DataFrame:
        """The first half of every hour of each video's day and of the next day."""
        first = self.read("orders").select(F.date_trunc("week", F.col("o_orderdate")).cast("date").alias("day")).distinct()
        days = first.select(F.explode(F.array("day", F.date_add("day", 1))).alias("day")).distinct()
        hour = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(23).cast("bigint")))
        keyed = days.select(F.date_format("day", "yyyyMMdd").cast("bigint").alias("d"), hour.alias("h"))
        key = F.col("d") * 100 + F.col("h")
        return keyed.select(
            key.alias("hour_key"), (key * 100).alias("bucket_start"), (key * 100 + 29).alias("bucket_end")
        )

    def spans(self) -> DataFrame:
        """Two buckets for each video's day: one over an hour's end, one over one to three midnights."""
        day = self.read("orders").select(F.date_trunc("week", F.col("o_orderdate")).alias("day")).distinct()

        def at(days, hours: int, minutes: int):
            moment = F.col("day") + F.make_dt_interval(days=days, hours=F.lit(hours), mins=F.lit(minutes))
            return F.date_format(moment, "yyyyMMddHHmm").cast("bigint")

        nights = F.dayofyear("day") % 3 + 1
        short = F.struct(at(F.lit(0), 5, 30).alias("bucket_start"), at(F.lit(0), 6, 45).alias("bucket_end"))
        long = F.struct(at(F.lit(0), 22, 40).alias("bucket_start"), at(nights, 1, 15).alias("bucket_end"))
        return day.select(F.explode(F.array(short, long)).alias("b")).select("b.*")

    def run_log(self) -> DataFrame:
        hour = F.date_trunc("hour", F.col("ts"))
        end = hour + F.make_dt_interval(hours=F.lit(1), mins=F.col("k").cast("int"))
        start_ms = F.unix_millis(F.col("ts").cast("timestamp"))
        return self.events().select(
            "event_id",
            F.col("user_id").cast("string").alias("task"),
            _lookup(F.col("event_type"), RUN_TYPE).alias("type"),
            F.concat(F.lit("node"), F.col("user_id") % 8).alias("node"),
            F.col("ts").alias("start"),
            start_ms.alias("start_ms"),
            (start_ms + F.round(F.col("value") * 100).cast("bigint")).alias("end_ms"),
            F.col("k").alias("n_samples"),
            F.concat_ws(
                "-",
                F.concat(F.lit("CAM0"), F.col("user_id") % 6 + 1),
                F.date_format(hour, NAME_FORMAT),
                F.date_format(end, NAME_FORMAT),
            ).alias("video"),
        )

    def device_reports(self) -> DataFrame:
        return self.events().where(F.col("event_type") == "view").select(
            (F.col("user_id") % 8).alias("node"),
            "ts",
            "event_id",
            F.col("user_id").alias("pid"),
            (F.col("k") % 8).alias("device"),
            F.col("value").alias("util"),
            F.round(F.col("value") * 100).cast("bigint").alias("mem"),
        )

    def processes(self) -> DataFrame:
        return self.device_reports().select("node", "pid", F.col("device").alias("gpu"), "mem")

    def containers(self) -> DataFrame:
        return self.read("customer").select(
            F.concat(F.lit("container-"), F.col("c_custkey")).alias("container"),
            (F.col("c_custkey") % 8).alias("node"),
            F.col("c_custkey").alias("pid"),
        )
