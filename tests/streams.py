"""Streams made of one file per batch, run to their end, also over several runs of one checkpoint."""

from __future__ import annotations

import os
import time

from sightline.sources import messages as M
from sightline.streaming import run, savers


def feed(spark, folder, batches, schema):
    """Write one file per batch; returns (source folder, names of its files, schema), the files not yet there."""
    made = []
    for n, rows in enumerate(batches):
        path = f"{folder}/made/{n:03d}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        part = next(f for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
        made.append(f"{path}/{part}")
    source = f"{folder}/source"
    os.makedirs(source)
    return source, made, spark.createDataFrame([], schema).schema


def outcome(spark, folder, build, fed, stop_after=(), with_query=False):
    """Rows of a stream that reads one file per batch; it is started anew after each number of files in ``stop_after``."""
    source, made, schema = fed
    query, begin = None, 0
    for end in [*stop_after, len(made)]:
        for n in range(begin, end):
            os.link(made[n], f"{source}/{n:03d}.parquet")
            stamp = time.time() - 1000 + n * 10
            os.utime(f"{source}/{n:03d}.parquet", (stamp, stamp))
        stream = M.read_files(spark, source, schema=schema, max_per_trigger=1)
        query = run.start(build(stream), f"{folder}/checkpoint", savers.append_saver(f"{folder}/out"), interval=None)
        query.awaitTermination()
        begin = end
    out = spark.read.parquet(f"{folder}/out")
    return (out, query) if with_query else out
