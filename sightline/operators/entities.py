"""The entity table: partial upserts on (entity_id, data_type) and lookups.

Tracking, scoring and feature results reach an entity in any order, each with
its own group of columns. Merging keeps the newest value of every group and
never overwrites a group with nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.names import packed_path
from sightline.functions.vectors import decode_feature

KEYS = ("entity_id", "data_type")

# A number that the entity alone decides. Updates with it lie by it, and are merged where they lie.
PART = "entity_id_part"

# Column groups that arrive together.
TRACK = ("path", "start_time", "start_frame", "boxes_json", "cam", "video")
FEATURE = ("reid_feature", "is_finish", "is_get_sim")


def feature_update(features: DataFrame) -> DataFrame:
    """Feature rows with the flags that mark an entity as ready for comparison."""
    return features.withColumns({"is_finish": F.lit(True), "is_get_sim": F.lit(False)})


def as_group(df: DataFrame, name: str, columns: Sequence[str], seq, keys: Sequence[str] = KEYS) -> DataFrame:
    """Bring one group's updates into merge form: keys, order of arrival and the group as a struct."""
    return df.select(*keys, F.struct(*columns).alias(name), seq.alias("seq"))


def merge_groups(parts: Sequence[DataFrame], groups: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Newest struct of every group per key.

    One shuffle for the stored rows and all updates; each task first reduces
    the updates of a key to one row. Updates that come alone and with ``PART``
    are merged in their parts; then the values of a type lie side by side, which
    columnar files store in less.
    """
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    for group in groups:
        if group not in merged.columns:
            raise ValueError(f"no part carries the group {group}")
    newest = [F.max_by(g, F.when(F.col(g).isNotNull(), F.col("seq"))).alias(g) for g in groups]
    together = [PART, *reversed(keys)] if len(parts) == 1 and PART in merged.columns else keys
    return merged.groupBy(*together).agg(*newest, F.max("seq").alias("seq")).select(*keys, *groups, "seq")


def flatten_groups(merged: DataFrame, groups: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Merge form -> one flat row per entity."""
    return merged.select(*keys, *[F.col(f"{g}.*") for g in groups])


def repath_complete(entities: DataFrame, groups: DataFrame, video_root, task: str = "task") -> DataFrame:
    """New archive paths for the entities of tasks that are completely stored."""
    done = groups.where("complete").select(task)
    return entities.join(done, task, "left_semi").withColumn(
        "path", packed_path(video_root, F.col(task), F.col("serial"))
    )


def archive_updates(entities: DataFrame, groups: DataFrame, video_root, seq, keys: Sequence[str] = KEYS) -> DataFrame:
    """The archive paths of complete tasks in merge form, as a column group of their own."""
    return as_group(repath_complete(entities, groups, video_root), "archive", ["path"], seq, keys)


def current_path() -> Column:
    """Where a merged entity lies: in its task's archive once there is one."""
    return F.coalesce("archive.path", "track.path")


def lookup(entities: DataFrame, probes: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Stored values of the probed keys; a missing key gives no row."""
    return probes.select(*keys).distinct().join(entities.select(*keys, *columns), list(keys))


def lookup_feature(entities: DataFrame, probes: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stored features of the probed keys, decoded."""
    return lookup(entities, probes, ["reid_feature"], keys).withColumn("vec", decode_feature(F.col("reid_feature")))


def pair_value(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored similarity of the probed pairs."""
    return pairs.select("src", "dst").distinct().join(links.select("src", "dst", "sim"), ["src", "dst"])
