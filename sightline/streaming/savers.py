"""What a micro-batch leaves behind; every saver can be given the same batch again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.aggregates import complete_groups
from sightline.operators.entities import KEYS, archive_updates, as_group
from sightline.operators.routing import drop_cancelled
from sightline.operators.timetree import time_bucket_join
from sightline.sources.upserts import write_updates

Saver = Callable[[DataFrame, int], None]


def entity_saver(root: str, groups: dict[str, Sequence[str]], keys: Sequence[str] = KEYS, seq: str = "seq") -> Saver:
    """Upsert the column groups present in a batch; rows of all kinds share the batch.

    A row updates a group when any of the group's columns is set.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        parts = None
        for name, columns in groups.items():
            has = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
            part = as_group(batch.where(has), name, columns, F.col(seq), keys)
            parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
        write_updates(parts, root, batch_id)

    return save


def edge_saver(root: str, buckets: Callable[[], DataFrame], keys: Sequence[str] = KEYS) -> Saver:
    """Place a batch's entities into the existing time buckets.

    Later batches may bring an entity again; ``read_edges`` counts each edge once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        placed = batch.where(F.col("start_time").isNotNull())
        time_bucket_join(placed, buckets(), keys).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return save


def archive_saver(
    root: str, stored: Callable[[], DataFrame], video_root: Column, keys: Sequence[str] = KEYS
) -> Saver:
    """Give the entities of a batch's tasks their archive paths once all members of a task are stored.

    ``stored`` reads what is stored so far: (task, serial, num) and the keys.
    The paths are updates of the group ``archive`` under ``root``; a task that
    several batches find complete gets the same paths again.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        members = stored().join(batch.select("task").distinct(), "task", "left_semi")
        members = members.dropDuplicates(["task", "serial", *keys])
        write_updates(archive_updates(members, complete_groups(members), video_root, F.lit(0), keys), root, batch_id)

    return save


def append_saver(root: str) -> Saver:
    """Keep a batch's rows under its number."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return save


def unless_cancelled(signals: Callable[[], DataFrame], saver: Saver, size: int = 100) -> Saver:
    """Drop cancelled tasks first; the signals are read anew for every batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        saver(drop_cancelled(batch, signals(), size), batch_id)

    return save
