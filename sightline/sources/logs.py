"""Append-only tables: run logs and similarity links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINK_LEVELS = ("minute", "hour")


def _append(rows: DataFrame, path: str, by: str, batch_id: int) -> None:
    """Add a batch; writing it again replaces it."""
    writer = rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(by, "batch_id").parquet(path)


def append_runs(runs: DataFrame, path: str, batch_id: int) -> None:
    """Append a batch of run-log rows, one folder per kind of run."""
    _append(runs, path, "type", batch_id)


def append_runs_jdbc(runs: DataFrame, table: str, **options: str) -> None:
    """Append run-log rows to a database table; ``options`` go to the JDBC writer as they are."""
    runs.write.format("jdbc").mode("append").options(dbtable=table, **options).save()


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def append_links(links: DataFrame, path: str, batch_id: int, level: str | None = None) -> None:
    """Append a batch of similarity links, one folder per level."""
    if level is not None:
        if level not in LINK_LEVELS:
            raise ValueError(f"level must be one of {LINK_LEVELS}")
        links = links.withColumn("level", F.lit(level))
    _append(links.select("src", "dst", "sim", "level"), path, "level", batch_id)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")
