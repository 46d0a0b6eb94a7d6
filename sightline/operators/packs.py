"""Packing many small files of a task into few large packs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.functions.names import int_div

PACK_BYTES = 128 << 20
CELL_PACKS = 64

# What a file costs besides its bytes, so that empty files fill a pack, too.
FILE_BYTES = 512


def plan_packs(
    files: DataFrame,
    keys: Sequence[str] = ("task",),
    member: str = "member",
    target: int = PACK_BYTES,
    cell_packs: int = CELL_PACKS,
) -> DataFrame:
    """Add ``pack`` and ``offset``: where each file of a task begins in which of its packs.

    ``files`` has ``length`` in bytes. A task is dealt by the hash of its
    members into cells of about ``cell_packs`` packs, and a cell fills its
    packs one after the other in the order of members. So no task meets more
    files than a cell holds, however large one key is, and a pack is over
    ``target`` by less than its last file. Files are sorted
    once. The plan depends on the files alone.
    A null length counts as 0; repeated rows are files of their own.
    """
    keys = list(keys)
    sized = files.withColumn("length", F.coalesce(F.col("length").cast("bigint"), F.lit(0)))
    weight = F.col("length") + FILE_BYTES
    cells = sized.groupBy(*keys).agg((int_div(F.sum(weight), target * cell_packs) + 1).alias("_cells"))
    place = F.conv(F.substring(F.md5(F.col(member).cast("string")), 1, 8), 16, 10).cast("bigint")
    dealt = sized.join(cells, keys).withColumn("_cell", F.coalesce(place, F.lit(0)) % F.col("_cells")).drop("_cells")
    by_cell = Window.partitionBy(*keys, "_cell").orderBy(member, "length")
    before = by_cell.rowsBetween(Window.unboundedPreceding, -1)
    packed = dealt.withColumns({
        "pack": F.shiftleft("_cell", 32) + int_div(F.coalesce(F.sum(weight).over(before), F.lit(0)), target),
        "_at": F.coalesce(F.sum("length").over(before), F.lit(0)),
    })
    # Places only grow in a cell, so a pack begins at the last place where one began.
    began = F.when(F.lag("pack").over(by_cell).eqNullSafe(F.col("pack")), F.lit(None)).otherwise(F.col("_at"))
    packed = packed.withColumn("_began", began)
    start = F.max("_began").over(by_cell.rowsBetween(Window.unboundedPreceding, 0))
    return packed.withColumn("offset", F.col("_at") - start).drop("_cell", "_at", "_began")
