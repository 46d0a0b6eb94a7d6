"""Routing of messages by topic, port, size and cancellation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators.ranking import recent_signals
from sightline.schema import PORTS, TOPICS

# Ids of cancelled tasks that are sent to every task.
BROADCAST_POOL = 10_000

# Messages above this size travel by reference.
MAX_PAYLOAD = 1_000_000


def topic_split(messages: DataFrame, schemas: dict[str, T.StructType], payload: str = "payload") -> dict[str, DataFrame]:
    """One typed frame per topic; the payload text is parsed with the topic's schema."""
    unknown = set(schemas) - set(TOPICS)
    if unknown:
        raise ValueError(f"unknown topics: {sorted(unknown)}")
    return {
        topic: messages.where(F.col("topic") == topic).withColumn(payload, F.from_json(payload, schema))
        for topic, schema in schemas.items()
    }


def for_port(messages: DataFrame, port: str, ports: str = "dest_ports") -> DataFrame:
    """Messages of the port's topic that are addressed to the port."""
    return messages.where((F.col("topic") == PORTS[port]) & F.array_contains(ports, port))


def complete_outputs(results: DataFrame, required: Sequence[str]) -> DataFrame:
    """Results that may be sent on: none of the required values is null."""
    return results.dropna(subset=list(required))


def drop_cancelled(messages: DataFrame, signals: DataFrame, size: int = 100) -> DataFrame:
    """Messages whose task is not among the last ``size`` cancelled ones.

    A pool of up to ``BROADCAST_POOL`` ids goes to every task; Spark decides about larger ones.
    """
    pool = recent_signals(signals, size=size).select("task")
    return messages.join(F.broadcast(pool) if size <= BROADCAST_POOL else pool, "task", "left_anti")


def by_reference(messages: DataFrame, payload: str, url, limit: int = MAX_PAYLOAD) -> DataFrame:
    """Replace payloads above ``limit`` bytes by the place they are stored at.

    Adds ``n_bytes``, ``stored`` and ``url``; an inline payload has no url.
    """
    size = F.octet_length(payload)
    return (
        messages.withColumn("n_bytes", size)
        .withColumn("stored", F.col("n_bytes") > limit)
        .withColumn("url", F.when(F.col("stored"), url))
        .withColumn(payload, F.when(~F.col("stored"), F.col(payload)))
    )


def resolve_reference(messages: DataFrame, stored: DataFrame, payload: str) -> DataFrame:
    """Inverse of :func:`by_reference`: fetch stored payloads by their url."""
    held = stored.select("url", F.col(payload).alias("_held"))
    return messages.join(held, "url", "left_outer").withColumn(
        payload, F.coalesce(payload, "_held")
    ).drop("_held")
