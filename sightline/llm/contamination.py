"""Benchmark passages in documents, found within an edit distance.

An item of n characters may differ in ``k`` of them, a share of n. Cut into
k + 1 pieces, at least one piece of it is in any passage that near without a
change. The pieces of all items are searched in one pass over a text. What lies
around the hits of an item, overlaps joined, is verified with Myers'
bit-parallel edit distance, so each character is verified once for an item
however often its pieces repeat.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import small_batches

# Edits allowed in a passage, as a share of the item's characters.
ERROR_RATE = 0.06

# Items with fewer characters than this are too common to tell anything.
LEAST_CHARS = 30

# Items travel to the tasks in blocks of this many characters.
ITEM_CHARS = 4 << 20

# Characters of a text that are searched at a time.
WINDOW_CHARS = 1 << 20

HITS = "array<struct<item_id:long,start:long,stop:long,distance:int>>"


def normal(text: str) -> str:
    """Letters and digits in lower case; everything between them is one blank."""
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into errors + 1 pieces of nearly equal length, as (place, piece)."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_end(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the nearest passage of ``text`` to ``pattern``, or None above ``most``; first end of ties.

    Myers' bit-parallel algorithm: one column of the edit matrix is held as
    two words of bits, of vertical steps up and down, and a character of the
    text moves the whole column.
    """
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best, at = most + 1, -1
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        right, left = (down | ~(diagonal | up)) & full, up & diagonal
        if right & high:
            score += 1
        elif left & high:
            score -= 1
        # A passage may begin anywhere, so nothing enters at the lowest bit.
        right, left = right << 1, left << 1
        up, down = (left | ~(diagonal | right)) & full, right & diagonal & full
        if score < best:
            best, at = score, j + 1
            if best == 0:
                break
    return (best, at) if best <= most else None


def _start(pattern: str, text: str, end: int, most: int) -> int:
    """Where the passage that ends at ``end`` begins: the nearest end of the reversed search."""
    back = text[max(0, end - len(pattern) - most) : end][::-1]
    found = best_end(pattern[::-1], back, most)
    return end - (found[1] if found else len(back))


def merged(regions: list[list[int]]) -> list[list[int]]:
    """Regions in order, those that overlap or touch joined."""
    out: list[list[int]] = []
    for low, high in sorted(regions):
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return out


class Matcher:
    """Searches texts for a block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, least: int):
        self.items = [(i, t, math.floor(error_rate * len(t))) for i, t in items if len(t) >= least]
        self.reach = max((len(t) + k for _, t, k in self.items), default=0)
        where: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, errors) in enumerate(self.items):
            for place, piece in pieces(text, errors):
                where.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, stop, distance) of the nearest passage per item, in the normalised text.

        A text is searched window by window; windows overlap by the longest
        passage, so none is cut.
        """
        if not self.items:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        step = max(WINDOW_CHARS, 2 * self.reach)
        for low in range(0, max(1, len(text)), step):
            window = text[low : low + step + self.reach]
            for number, found in self._window(window).items():
                distance, start, stop = found
                found = (distance, low + start, low + stop)
                best[number] = min(best.get(number, found), found)
        return [(self.items[n][0], start, stop, distance) for n, (distance, start, stop) in sorted(best.items())]

    def _regions(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the [low, high] of the text around its pieces; regions that overlap are one."""
        found: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for number, place in places:
                item, errors = self.items[number][1:]
                start = last + 1 - length - place
                low, high = max(0, start - errors), min(len(text), start + len(item) + errors)
                regions = found.setdefault(number, [])
                if regions and low <= regions[-1][1] and high >= regions[-1][0]:
                    regions[-1] = [min(low, regions[-1][0]), max(high, regions[-1][1])]
                else:
                    regions.append([low, high])
        return {number: merged(regions) for number, regions in found.items()}

    def _window(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Nearest passage per item as (distance, start, stop); a character is verified once for an item."""
        best: dict[int, tuple[int, int, int]] = {}
        for number, regions in self._regions(text).items():
            item, errors = self.items[number][1:]
            most = errors
            for low, high in regions:
                if high - low < len(item) - errors:
                    continue
                around = text[low:high]
                found = best_end(item, around, most)
                if found:
                    distance, end = found
                    best[number] = (distance, low + _start(item, around, end, errors), low + end)
                    # Only a nearer passage replaces the first.
                    most = distance - 1
                if most < 0:
                    break
        return best


def _blocks(benchmark: DataFrame, item_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``item_chars`` characters; only one block is on the driver."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    count = max(1, math.ceil(total / item_chars))
    for block in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).orderBy("item_id", "text")
        yield [(r["item_id"], normal(r["text"])) for r in own.toLocalIterator()]


def passages(
    spark: SparkSession, text: Column, items: list[tuple[int, str]], error_rate: float = ERROR_RATE, least: int = LEAST_CHARS
) -> Column:
    """Array of (item_id, start, stop, distance) of a text: the nearest passage of each item that is near enough.

    Places count characters of the normalised text. Null and empty texts have none.
    """

    what = (items, error_rate, least)
    mark = hashlib.sha256(repr(what).encode("utf-8", "surrogatepass")).hexdigest()
    shared = spark.sparkContext.broadcast(what)

    @F.pandas_udf(HITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # A worker serves many tasks and keeps the matcher of the last block.
        held = vars(sys).setdefault("_sightline_matcher", {})
        if mark not in held:
            held.clear()
            held[mark] = Matcher(*shared.value)
        matcher = held[mark]
        names = ("item_id", "start", "stop", "distance")
        for batch in batches:
            yield pd.Series(
                [[dict(zip(names, hit, strict=True)) for hit in matcher.search(normal(t))] if t else [] for t in batch]
            )

    return find(text)


def leaks(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least: int = LEAST_CHARS, item_chars: int = ITEM_CHARS
) -> DataFrame:
    """(doc_id, item_id, start, stop, distance): each document with each item it holds a passage of.

    Case, punctuation and white space do not count. An item may differ in
    ``error_rate`` of its characters, rounded down; items of fewer than
    ``least`` characters, null items and null texts match nothing. Repeated
    documents repeat their rows; items with one id and several texts give a
    row for each. Every block of items is one pass over the documents.
    """
    small_batches(docs.sparkSession)
    out = None
    for items in _blocks(benchmark, item_chars):
        hits = passages(docs.sparkSession, F.col("text"), items, error_rate, least)
        found = docs.select("doc_id", F.explode(hits).alias("hit"))
        found = found.select("doc_id", "hit.*")
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least: int = LEAST_CHARS, item_chars: int = ITEM_CHARS
) -> DataFrame:
    """Documents without a passage of any item; the columns are those of ``docs``."""
    small_batches(docs.sparkSession)
    for items in _blocks(benchmark, item_chars):
        docs = docs.where(F.size(passages(docs.sparkSession, F.col("text"), items, error_rate, least)) == 0)
    return docs
