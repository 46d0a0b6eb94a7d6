"""Stored entities: headers, boxes and samples as partitioned files, and their discovery."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions.names import parent_dir
from sightline.functions.payload import to_base64
from sightline.operators.ranking import latest_per_key
from sightline.schema import HEADER, SAMPLE_LINE


def plain_path(path: Column) -> Column:
    """A path without scheme and authority, as two names of one file are compared."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def _plain(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/", path).rstrip("/")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below a folder, with size and time; contents are not read, and Spark lists no empty files.

    Local paths lose their scheme.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path = F.regexp_replace("path", "^file:/+", "/")
    return reader.load(root).select(path.alias("path"), "length", F.col("modificationTime").alias("modified"))


def stored_dirs(files: DataFrame, root: str, check: bool = True) -> DataFrame:
    """Folders exactly two levels below ``root/<video>``: one per stored entity.

    Works on a listing, so one listing serves all videos. Schemes and
    authorities don't count: a bare root matches an ``hdfs://`` listing and the
    other way round; ``url`` begins as ``root`` does. With ``check`` a root
    that holds none of the listed files is an error.
    """
    plain, path = _plain(root), plain_path(F.col("path"))
    inside = files.where(path.startswith(plain + "/"))
    if check and inside.isEmpty() and not files.isEmpty():
        raise ValueError(f"no listed file is below {root}")
    parts = F.split(F.substring(path, F.lit(len(plain) + 2), F.char_length(path)), "/")
    found = inside.where(F.size(parts) >= 4)
    return found.select(
        F.get(parts, F.lit(0)).alias("video"),
        F.get(parts, F.lit(1)).alias("task"),
        F.get(parts, F.lit(2)).alias("serial"),
        F.concat_ws("/", F.lit(root.rstrip("/")), F.slice(parts, 1, 3)).alias("url"),
    ).distinct()


def archive_member(path):
    """Path inside an archive -> path as a reader resolves it, else the path itself."""
    return F.when(path.rlike(r"\.har(/|$)") & ~path.startswith("har:"), F.concat(F.lit("har://"), path)).otherwise(path)


def write_entities(
    headers: DataFrame, boxes: DataFrame, root: str, batch_id: int, partition: str = "video", spread: int = 1
) -> None:
    """Store a batch of entities as three tables below ``root``.

    ``headers`` has one row per entity without boxes, ``boxes`` all positions,
    and only boxes with pixels enter ``samples``. A batch that is written again
    replaces itself. Rows are dealt by ``partition`` and, for large videos,
    over ``spread`` tasks each, so a task writes few files; the headers come
    last, as an entity counts once its header is there.
    """
    plain = [c for c in boxes.columns if c != "patch"]
    for name, df in (
        ("boxes", boxes.select(*plain)),
        ("samples", boxes.where(F.col("patch").isNotNull())),
        ("headers", headers),
    ):
        by = [partition] if partition in df.columns else []
        salt = F.pmod(F.xxhash64(*plain if name == "boxes" else df.columns[:2]), F.lit(spread))
        dealt = df.repartition(*by, salt).withColumn("batch_id", F.lit(batch_id))
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by, "batch_id").parquet(f"{root}/{name}")


def read_entities(
    spark: SparkSession, root: str, keys: Sequence[str] = ("video", "serial", "idx")
) -> tuple[DataFrame, DataFrame]:
    """Headers, and the boxes with the pixels of those that were sampled.

    An entity stored by several batches is read as the last one left it;
    ``keys`` are its key columns and, at the end, the place of a box in it.
    """
    entity = list(keys)[:-1]
    headers = latest_per_key(spark.read.parquet(f"{root}/headers"), entity, ["batch_id"])
    last = headers.select(*entity, "batch_id")
    boxes = spark.read.parquet(f"{root}/boxes").join(last, [*entity, "batch_id"], "left_semi")
    samples = spark.read.parquet(f"{root}/samples").select(*keys, "batch_id", "patch")
    return headers.drop("batch_id"), boxes.join(samples, [*keys, "batch_id"], "left_outer").drop("batch_id")


def read_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One-line JSON headers, one row per entity, with the folder each came from."""
    return (
        spark.read.schema(HEADER)
        .json(paths)
        .withColumn("path", F.regexp_replace(F.input_file_name(), "^file:/+", "/"))
        .withColumn("url", parent_dir(F.col("path")))
    )


def headers_of(entities: DataFrame, headers: DataFrame) -> DataFrame:
    """Headers of the given entity folders, whatever scheme either is named with; null where a folder has none."""
    own = headers.drop("path").withColumn("_plain", plain_path(F.col("url"))).drop("url")
    return entities.withColumn("_plain", plain_path(F.col("url"))).join(own, "_plain", "left_outer").drop("_plain")


def read_sample_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON sample lines -> typed boxes with pixels, and the folder each came from."""
    lines = spark.read.schema(SAMPLE_LINE).json(paths)
    path = F.regexp_replace(F.input_file_name(), "^file:/+", "/")
    return lines.select(
        parent_dir(path).alias("url"),
        *[F.col(c).cast("int").alias(c) for c in ("idx", "x", "y", "width", "height")],
        F.unbase64("data").alias("patch"),
    )


def sample_lines(boxes: DataFrame) -> DataFrame:
    """Boxes with pixels as JSON lines of text values, for ``write.text``."""
    row = F.struct(
        *[F.col(c).cast("string").alias(c) for c in ("idx", "x", "y", "width", "height")],
        to_base64(F.col("patch")).alias("data"),
    )
    return boxes.where(F.col("patch").isNotNull()).select(F.to_json(row).alias("value"))


def restore_boxes(headers: DataFrame, samples: DataFrame) -> DataFrame:
    """Boxes of read headers, with the pixels of the sample lines."""
    boxes = headers.select("url", F.posexplode("bounding-boxes").alias("idx", "_box")).select("url", "idx", "_box.*")
    return boxes.join(samples.select("url", "idx", "patch"), ["url", "idx"], "left_outer")
