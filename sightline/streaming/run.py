"""Starting and observing queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# A micro-batch starts this often.
INTERVAL = "2 seconds"


def start(
    stream: DataFrame,
    checkpoint: str,
    save: Callable[[DataFrame, int], None],
    interval: str | None = INTERVAL,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Run ``save`` on every micro-batch; without an interval, work off what is there and stop.

    The checkpoint is kept between runs: it says which input is done, and a
    batch that was cut off is given to ``save`` again under its old number.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def save_all(*savers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several outputs from one reading of a micro-batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for saver in savers:
                saver(batch, batch_id)
        finally:
            batch.unpersist()

    return save


def new_messages(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch, new rows) of the query's recent micro-batches."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]
