"""Keyed messages: a broker or a folder of files as the source, a broker or files as the sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.schema import MESSAGE


def read_topics(
    spark: SparkSession,
    topics: Sequence[str],
    servers: str,
    max_per_trigger: int | None = None,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Stream of (topic, task, value, partition, offset, ts) from a Kafka broker.

    Needs the Spark Kafka package on the classpath. Progress lives in the
    query's checkpoint; nothing is committed before a batch is done.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    for name, value in options.items():
        reader = reader.option(name.replace("__", "."), value)
    raw = reader.load()
    return raw.select(
        "topic", F.col("key").cast("string").alias("task"), "value", "partition", "offset", F.col("timestamp").alias("ts")
    )


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE,
    fmt: str = "parquet",
    topics: Sequence[str] | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """The same kind of stream from files that appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    stream = reader.load(path)
    if topics is not None:
        stream = stream.where(F.col("topic").isin(list(topics)))
    return stream


def spread(stream: DataFrame, partitions: int = -1) -> DataFrame:
    """Spread input rows evenly: -1 leaves them, 0 uses the default parallelism."""
    if partitions < 0:
        return stream
    return stream.repartition(partitions or stream.sparkSession.sparkContext.defaultParallelism)


def to_records(messages: DataFrame, key: str = "task", topic: str = "topic") -> DataFrame:
    """Messages as (topic, key, value) with the remaining columns as one JSON value."""
    rest = [c for c in messages.columns if c not in (key, topic)]
    return messages.select(
        F.col(topic).alias("topic"), F.col(key).alias("key"), F.to_json(F.struct(*rest)).alias("value")
    )


def address(results: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """One message per plan node that a node's results feed, with the ports as an array.

    Results carry ``task``; an edge row names its source node, target node,
    output type and port. Results of a node without outgoing edges end here.
    """
    targets = edges.where(F.col("src") == node).select(
        "task", "dst", F.col("output_type").alias("topic"), F.array("port").alias("dest_ports")
    )
    return results.join(targets, "task")


def write_topics(messages: DataFrame, servers: str, checkpoint: str, interval: str = "2 seconds"):
    """Send (topic, key, value) rows to a Kafka broker."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )
