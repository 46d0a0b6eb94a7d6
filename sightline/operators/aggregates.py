"""Aggregations over scores, groups and run logs. All combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import PACKED, int_div, video_part


def mean_scores(samples: DataFrame, scores: Sequence[str], keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Mean of every score over the samples of an entity; entities without samples give no row."""
    return samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"), *[F.avg(s).alias(s) for s in scores]
    )


def complete_groups(stored: DataFrame, group: str = "task", member: str = "serial", declared: str = "num") -> DataFrame:
    """Whether all declared members of a group are stored, and how many are missing."""
    per_member = stored.groupBy(group, member).agg(F.max(declared).alias(declared))
    return (
        per_member.groupBy(group)
        .agg(F.count(member).alias("n_stored"), F.max(declared).alias("n_declared"))
        .withColumn("missing", F.col("n_declared") - F.col("n_stored"))
        .withColumn("complete", F.col("missing") == 0)
    )


def topic_counts(messages: DataFrame) -> DataFrame:
    """New messages per topic and partition, with the subtotal of each topic and the total."""
    per_partition = messages.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n_messages"))
    return per_partition.rollup("topic", "partition").agg(F.sum("n_messages").alias("n_messages"))


def mean_cost(run_log: DataFrame, keys: Sequence[str] = ("type", "node")) -> DataFrame:
    """Whole milliseconds per run and per sample."""
    elapsed = F.col("end_ms") - F.col("start_ms")
    return (
        run_log.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.sum("n_samples").alias("n_samples"),
            F.sum(elapsed).alias("total_ms"),
        )
        .withColumn("ms_per_run", int_div(F.col("total_ms"), F.col("n_runs")))
        .withColumn(
            "ms_per_sample", F.when(F.col("n_samples") > 0, int_div(F.col("total_ms"), F.col("n_samples")))
        )
    )


def runs_since(run_log: DataFrame, since: Column) -> DataFrame:
    return run_log.where(F.col("start") > since)


def distinct_since(run_log: DataFrame, since: Column) -> DataFrame:
    """Videos with a run after a time."""
    return runs_since(run_log, since).select("video").distinct()


def video_duration(videos: DataFrame, video: str = "video") -> DataFrame:
    """Milliseconds between the two times in each video name."""
    def at(part: str) -> Column:
        return F.unix_millis(F.try_to_timestamp(video_part(F.col(video), part), F.lit(PACKED)))

    return videos.withColumn("duration_ms", at("end") - at("start"))


def total_duration(videos: DataFrame) -> DataFrame:
    """Sum of :func:`video_duration` over all videos."""
    return video_duration(videos).agg(
        F.count(F.lit(1)).alias("n_videos"), F.sum("duration_ms").alias("total_ms")
    )


def merge_executed(nodes: DataFrame, keys: Sequence[str] = ("plan", "node")) -> DataFrame:
    """Merge copies of plans: a node is executed when it is in any copy."""
    return nodes.groupBy(*keys).agg(F.bool_or("executed").alias("executed"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows in each partition."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def first_column(df: DataFrame) -> DataFrame:
    """First column of an ad-hoc query's result."""
    return df.select(df.columns[0])
