"""The pool of cancelled tasks, carried from one micro-batch to the next."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators.ranking import recent_signals
from sightline.streaming.savers import Saver


class SignalPool:
    """The ``size`` ids signalled last, under ``root``: what a batch leaves is all the next one reads.

    Two slots take turns, so a batch that is given again finds the pool of the
    batch before it as it was. An id's place is that of its latest signal; ties
    go to the smaller id. ``size`` bounds what is kept, read and broadcast.
    """

    def __init__(self, root: str, size: int = 100, id_col: str = "task", ts_col: str = "ts"):
        self.root = root
        self.size = size
        self.id_col = id_col
        self.ts_col = ts_col

    def before(self, like: DataFrame, batch_id: int) -> DataFrame:
        """The pool as the last batch before ``batch_id`` left it, with the columns of ``like``; empty before any."""
        spark: SparkSession = like.sparkSession
        rows = []
        try:
            # At most ``size`` rows and a mark in each of the two slots.
            rows = spark.read.parquet(self.root).where(F.col("batch_id") < batch_id).collect()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        newest = max((r.batch_id for r in rows), default=None)
        kept = [(r[self.id_col], r[self.ts_col]) for r in rows if r.batch_id == newest and not r.is_mark]
        return spark.createDataFrame(kept, like.select(self.id_col, self.ts_col).schema)

    def advance(self, signals: DataFrame, batch_id: int) -> DataFrame:
        """The pool after a batch's signals, stored for the next batch."""
        own = signals.select(self.id_col, self.ts_col).where(F.col(self.id_col).isNotNull())
        pool = recent_signals(self.before(own, batch_id).unionByName(own), self.id_col, self.ts_col, self.size)
        mark = own.sparkSession.range(1).select(
            *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in own.columns], F.lit(True).alias("is_mark")
        )
        rows = pool.withColumn("is_mark", F.lit(False)).unionByName(mark).withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/slot={batch_id % 2}")
        return self.before(own, batch_id + 1)


def drop_signalled(pool: SignalPool, is_signal: Column, saver: Saver) -> Saver:
    """Take a batch's signals into the pool, and save its other rows but those of signalled tasks.

    Signals and messages come in one stream; a batch reads its own rows and the
    pool, never earlier signals.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            signal = F.coalesce(is_signal, F.lit(False))
            held = pool.advance(batch.where(signal), batch_id).select(pool.id_col)
            saver(batch.where(~signal).join(F.broadcast(held), pool.id_col, "left_anti"), batch_id)
        finally:
            batch.unpersist()

    return save
