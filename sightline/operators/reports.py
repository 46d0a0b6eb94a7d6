"""Reports of nodes, devices and containers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.ranking import latest_per_key


def latest_per_node(reports: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The newest report of each node."""
    return latest_per_key(reports, ["node"], list(order))


def free_devices(devices: DataFrame, busy: DataFrame, keys: Sequence[str] = ("node", "device")) -> DataFrame:
    """Devices that no process uses."""
    return devices.select(*keys).distinct().join(busy.select(*keys).distinct(), list(keys), "left_anti")


def free_in_report(reports: DataFrame, devices: str = "devNumList", busy: str = "processNumAllList") -> DataFrame:
    """Nested form: the free devices of each report row."""
    return reports.withColumn("free", F.array_except(devices, busy))


def explode_devices(reports: DataFrame) -> DataFrame:
    """Server reports -> one row per device."""
    return reports.select("nodeName", "ip", F.explode("devInfosList").alias("_d")).select("nodeName", "ip", "_d.*")


def explode_processes(reports: DataFrame) -> DataFrame:
    """Server reports -> one row per process and GPU, as the container join reads them."""
    return reports.select(F.col("nodeName").alias("node"), F.explode("processAllList").alias("_p")).select(
        "node", F.col("_p.pid").alias("pid"), F.col("_p.index").alias("gpu"), F.col("_p.usedGpuMemory").alias("mem")
    )


def report_messages(reports: DataFrame, topic_prefix: str, key: str = "nodeName") -> DataFrame:
    """Reports as keyed JSON messages, one topic per reporter."""
    topic = F.concat(F.lit(topic_prefix), F.col(key))
    return reports.select(topic.alias("topic"), topic.alias("key"), F.to_json(F.struct("*")).alias("value"))
