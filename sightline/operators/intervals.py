"""Joins on overlapping intervals of whole numbers, as equality of bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Widths of bins are powers of two, this many doublings apart.
STEP = 2


def _shifted(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def _level(start: Column, end: Column, step: int) -> Column:
    """Smallest level whose bins, 2 ** level wide, are longer than the interval reaches; it then touches two at most."""
    # Bounds may be further apart than a long can say.
    digits = F.when(end == start, F.lit(0)).otherwise(F.coalesce(F.length(F.bin(F.try_subtract(end, start))), F.lit(63)))
    return F.least(F.ceil(digits / step) * step, F.lit(63)).cast("int")


def _levels(df: DataFrame) -> list[int]:
    """Levels that occur; there are at most 64."""
    return sorted(r[0] for r in df.select("_level").distinct().collect())


def _in_bins(df: DataFrame, at: Column) -> DataFrame:
    """A row for each bin of the level ``at`` that the interval touches."""
    at_level = df.withColumn("_at", at)
    return at_level.withColumn(
        "_bin", F.explode(F.sequence(_shifted(F.col("_start"), F.col("_at")), _shifted(F.col("_end"), F.col("_at"))))
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    keys: Sequence[str] = (),
    step: int = STEP,
) -> DataFrame:
    """Every pair of rows with equal ``keys`` whose closed intervals share a point, once.

    A span names the columns of an interval's first and last point, whole
    numbers; one column twice makes points. Rows without a key or a bound, or
    that end before they start, pair with nothing. Columns other than the keys
    must differ in name between the sides.

    Lengths decide the bins: an interval belongs to the level whose bins are
    just longer than itself, so it touches two of them at most, however long it
    is. Two intervals meet in bins of the longer one's level, to which the
    shorter one is copied, and the pair counts only in the bin where the later
    of the two starts. So neither long intervals nor many levels multiply rows,
    nothing is compared across bins, and AQE can split a crowded bin. A row is
    copied once per level at or above its own that occurs on the other side.
    """
    keys = list(keys)

    def prepared(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        start, end = (F.col(c).cast("long") for c in span)
        rows = df.dropna(subset=[*keys, *span]).withColumn("_start", start).withColumn("_end", end)
        return rows.where(F.col("_start") <= F.col("_end")).withColumn("_level", _level(F.col("_start"), F.col("_end"), step))

    a, b = prepared(left, left_span), prepared(right, right_span)
    levels_a, levels_b = _levels(a), _levels(b)

    def copies(df: DataFrame, levels: list[int], strict: bool) -> DataFrame:
        """The intervals in bins of every one of these levels above, or not below, their own."""
        known = F.array(*[F.lit(v) for v in levels]).cast("array<int>")
        own = F.col("_level")
        above = F.filter(known, lambda v: v > own if strict else v >= own)
        return _in_bins(df.withColumn("_up", F.explode(above)), F.col("_up"))

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*keys, "_at", "_bin")]
        later = F.greatest(F.col("x._start"), F.col("y._start"))
        overlap = (F.col("x._start") <= F.col("y._end")) & (F.col("y._start") <= F.col("x._end"))
        here = _shifted(later, F.col("x._at")) == F.col("x._bin")
        rest = [F.col(f"y.{c}") for c in right.columns if c not in keys]
        return x.join(y, same).where(overlap & here).select(*[F.col(f"x.{c}") for c in left.columns], *rest)

    # The left one is the longer, or as long; then the right one.
    own_left, own_right = _in_bins(a, F.col("_level")), _in_bins(b, F.col("_level"))
    return met(own_left, copies(b, levels_a, strict=False)).unionByName(met(copies(a, levels_b, strict=True), own_right))
