"""Placing entities into the time hierarchy year > month > day > hour > minute bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import PACKED, int_div, time_key
from sightline.operators.intervals import interval_join

LEVELS = ("year", "month", "day", "hour")


def with_time_keys(entities: DataFrame, time: str = "start_time") -> DataFrame:
    """Add the hierarchy keys of a packed time as numbers."""
    return entities.withColumns({
        f"{level}_key": time_key(F.col(time), level).try_cast("bigint") for level in LEVELS
    })


def time_bucket_join(
    entities: DataFrame,
    buckets: DataFrame,
    keys: Sequence[str] = ("entity_id",),
    time: str = "start_time",
) -> DataFrame:
    """Edges from existing minute buckets to the entities that start inside them.

    A bucket hangs under one hour and covers ``bucket_start`` to ``bucket_end``,
    both packed to the minute, to the last second of its end. Joined on the hour
    with the range as a condition, so no entity meets a bucket of another hour.
    An edge is created once. Entities outside every bucket get none. Buckets
    that reach over an hour need :func:`span_edges`.
    """
    # Neither is ever null, so that Spark does not compute the time again for null checks.
    packed = entities.select(*keys, F.coalesce(F.col(time).try_cast("bigint"), F.lit(-1)).alias("_t"))
    hour = F.coalesce(int_div(F.col("_t"), 10_000), F.lit(-1))
    placed = packed.withColumn("hour_key", hour).join(
        buckets.select("hour_key", "bucket_start", "bucket_end"), "hour_key"
    ).where(
        (F.col("bucket_start") * 100 <= F.col("_t")) & (F.col("_t") <= F.col("bucket_end") * 100 + 59)
    )
    return placed.select("hour_key", "bucket_start", "bucket_end", *keys).dropDuplicates(["bucket_start", *keys])


def span_edges(
    entities: DataFrame, spans: DataFrame, keys: Sequence[str] = ("entity_id",), time: str = "start_time"
) -> DataFrame:
    """Edges from buckets of any length, also across hours and days, to the entities that start inside them.

    ``bucket_start`` and ``bucket_end`` are packed to the minute and inclusive
    to the last second. Buckets may overlap. Times that can't be read are in no
    bucket; an edge is created once.
    """

    def seconds(packed, form: str):
        return F.unix_timestamp(F.try_to_timestamp(packed.cast("string"), F.lit(form)))

    minute = PACKED[: PACKED.index("ss")]
    starts = entities.select(*keys, seconds(F.col(time), PACKED).alias("_t"))
    buckets = spans.select(
        "bucket_start",
        "bucket_end",
        seconds(F.col("bucket_start"), minute).alias("_from"),
        (seconds(F.col("bucket_end"), minute) + 59).alias("_until"),
    )
    edges = interval_join(starts, buckets, ("_t", "_t"), ("_from", "_until"))
    return edges.select("bucket_start", "bucket_end", *keys).distinct()


def bucket_counts(edges: DataFrame) -> DataFrame:
    """Members of each bucket."""
    return edges.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("n_members"))
