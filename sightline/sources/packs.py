"""Packed files of complete tasks: packs of bytes and an index from paths to ranges in them.

A batch first stores its packs and then its index; readers go through the
index, so packs that were written halfway are not seen. A batch that is
written again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators.packs import PACK_BYTES, plan_packs
from sightline.operators.ranking import latest_per_key
from sightline.sources.files import _plain, plain_path

INDEX = ("video", "task", "member", "path", "pack", "offset", "length")


def task_files(files: DataFrame, root: str, groups: DataFrame) -> DataFrame:
    """(video, task, member, path, length) of the listed files ``root/<video>/<task>/<member>`` of complete tasks.

    ``groups`` is what :func:`~sightline.operators.aggregates.complete_groups` makes.
    """
    plain, path = _plain(root), plain_path(F.col("path"))
    parts = F.split(F.substring(path, F.lit(len(plain) + 2), F.char_length(path)), "/")
    member = F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "/")
    inside = files.where(path.startswith(plain + "/")).withColumn("_parts", parts).where(F.size("_parts") >= 3)
    named = inside.select(
        F.get("_parts", F.lit(0)).alias("video"), F.get("_parts", F.lit(1)).alias("task"), member.alias("member"), "path", "length"
    )
    return named.join(groups.where("complete").select("task").distinct(), "task", "left_semi")


def write_packs(files: DataFrame, contents: DataFrame, root: str, batch_id: int, target: int = PACK_BYTES) -> DataFrame:
    """Pack ``files`` (as of :func:`task_files`) with their ``contents`` (path, content); gives back the index.

    Files of ``target`` bytes and more stay where they are. A file that is
    gone, or whose bytes are not as many as were listed, is an error, and
    nothing of the batch is seen.
    """
    spark = files.sparkSession
    plan = plan_packs(files.where(F.col("length") < target), ["video", "task"], target=target)
    # The source drops files by their length before it reads them, so the limit is said again.
    small = contents.where(F.col("length") < target) if "length" in contents.columns else contents
    data = plan.withColumn("_plain", plain_path(F.col("path"))).join(
        small.select(plain_path(F.col("path")).alias("_plain"), F.col("content").alias("data")), "_plain", "left_outer"
    )
    dealt = data.drop("_plain").repartition("video", "task", "pack").sortWithinPartitions("video", "task", "pack", "offset")
    _store(dealt.select(*INDEX, "data"), f"{root}/data", batch_id)
    stored = spark.read.parquet(f"{root}/data").where(F.col("batch_id") == batch_id)
    whole = F.coalesce(F.octet_length("data") == F.col("length"), F.lit(False))
    if not stored.where(~whole).isEmpty():
        raise ValueError("files were changed since they were listed")
    _store(stored.select(*INDEX), f"{root}/index", batch_id)
    return read_index(spark, root)


def _store(df: DataFrame, path: str, batch_id: int) -> None:
    writer = df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """Every packed file with its pack, offset and length; of several batches the last one counts."""
    return latest_per_key(spark.read.parquet(f"{root}/index"), ["video", "task", "member"], ["batch_id"])


def packed_members(paths: DataFrame) -> DataFrame:
    """(path, video, task, member) of archive paths ``.../<video>/<task>.har/<member>``; other paths give no row."""
    pattern = r"([^/]+)/([^/]+)\.har/(.+)$"
    named = [F.regexp_extract("path", pattern, i + 1).alias(c) for i, c in enumerate(("video", "task", "member"))]
    return paths.where(F.col("path").rlike(pattern)).select("path", *named)


def read_members(spark: SparkSession, root: str, members: DataFrame) -> DataFrame:
    """(video, task, member, data): the bytes of the asked files; an entity's folder as member gives all its files."""
    asked = members.select("video", "task", F.col("member").alias("_asked")).distinct()
    index = read_index(spark, root).withColumn("_parts", F.split("member", "/"))
    # A file is found by its own name and by each of its folders.
    names = F.transform(F.sequence(F.lit(1), F.size("_parts")), lambda n: F.array_join(F.slice("_parts", F.lit(1), n), "/"))
    hits = index.withColumn("_asked", F.explode(names)).join(asked, ["video", "task", "_asked"], "left_semi")
    place = ["batch_id", "video", "task", "member", "pack", "offset"]
    data = spark.read.parquet(f"{root}/data").select(*place, "data")
    return data.join(hits.select(*place).distinct(), place, "left_semi").select("video", "task", "member", "data")


def read_range(spark: SparkSession, root: str, batch_id: int, video: str, task: str, pack: int, start: int, end: int) -> DataFrame:
    """(offset, data): the bytes of one pack from ``start`` up to ``end``, in pieces that follow each other."""
    rows = read_index(spark, root).where(
        (F.col("batch_id") == batch_id) & (F.col("video") == video) & (F.col("task") == task) & (F.col("pack") == pack)
    ).where((F.col("offset") < end) & (F.col("offset") + F.col("length") > start))
    place = ["batch_id", "video", "task", "member", "pack", "offset"]
    data = spark.read.parquet(f"{root}/data").where(
        (F.col("batch_id") == batch_id) & (F.col("task") == task) & (F.col("pack") == pack) & (F.col("offset") < end)
    )
    skip = F.greatest(F.lit(start) - F.col("offset"), F.lit(0))
    piece = F.substring(F.col("data"), skip.cast("int") + 1, (F.lit(end) - F.col("offset") - skip).cast("int"))
    return data.join(rows.select(*place), place, "left_semi").select((F.col("offset") + skip).alias("offset"), piece.alias("data"))
