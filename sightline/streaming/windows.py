"""Counts of a running stream: members of time buckets, and messages per topic and partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sightline.functions.names import PACKED, int_div

HOUR = "1 hour"


def bucket_counts(
    entities: DataFrame,
    buckets: DataFrame,
    keys: Sequence[str] = ("entity_id",),
    time: str = "start_time",
    delay: str = HOUR,
) -> DataFrame:
    """Members of each bucket, given out once when no more can come: (bucket_start, n_members).

    ``entities`` is a stream, ``buckets`` the stored minute buckets, each inside
    one hour. The packed start time is the event time; the watermark follows it
    by ``delay``, and entities later than that are left out, as are those whose
    time can't be read. An entity that comes again within the delay counts once.
    """
    at = F.try_to_timestamp(F.col(time), F.lit(PACKED))
    timed = entities.withColumn("w_at", at).where(F.col("w_at").isNotNull()).withWatermark("w_at", delay)
    timed = timed.select(*keys, "w_at", F.col(time).cast("bigint").alias("w_t")).dropDuplicatesWithinWatermark([*keys, "w_t"])
    placed = timed.withColumn("hour_key", int_div(F.col("w_t"), 10_000)).join(
        buckets.select("hour_key", "bucket_start", "bucket_end"), "hour_key"
    )
    inside = (F.col("bucket_start") * 100 <= F.col("w_t")) & (F.col("w_t") <= F.col("bucket_end") * 100 + 59)
    counted = placed.where(inside).groupBy(F.window("w_at", HOUR), "bucket_start").agg(F.count(F.lit(1)).alias("n_members"))
    return counted.select("bucket_start", "n_members")


def window_counts(
    messages: DataFrame, width: str = HOUR, keys: Sequence[str] = ("topic", "partition"), time: str = "ts", delay: str = HOUR
) -> DataFrame:
    """New messages per window of event time and key, given out once the watermark has passed the window."""
    timed = messages.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    counted = timed.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n_messages"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n_messages")


COUNTS = "topic_counts"


def observe_topics(messages: DataFrame, topics: Sequence[str], partitions: int) -> DataFrame:
    """The same stream, counted on its way: every progress report tells the rows of each topic and partition.

    A topic or partition that is not named counts as ``other``.
    """
    cell = [
        F.count(F.when((F.col("topic") == t) & (F.col("partition") == p), 1)).alias(f"{t}/{p}")
        for t in topics
        for p in range(partitions)
    ]
    known = F.col("topic").isin(list(topics)) & F.col("partition").between(0, partitions - 1)
    return messages.observe(COUNTS, *cell, F.count(F.when(~F.coalesce(known, F.lit(False)), 1)).alias("other"))


class TopicListener(StreamingQueryListener):
    """Hands the counts of every batch that had rows to ``save``: (batch, [(topic, partition, rows)])."""

    def __init__(self, save: Callable[[int, list[tuple[str, int | None, int]]], None]):
        self.save = save

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(COUNTS)
        if found is not None and any(found):
            counts = []
            for name, n in found.asDict().items():
                topic, _, partition = name.rpartition("/")
                if n:
                    counts.append((topic or name, int(partition) if topic else None, n))
            self.save(event.progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
