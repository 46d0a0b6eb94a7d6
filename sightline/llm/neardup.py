"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

A document is the set of its word shingles. Documents with equal sets are one
class. Signatures of the classes are cut into bands; classes that agree in a
band are candidates. Candidates are compared by further signature values, a
batch at a time, and given up once the posterior probability that they are
similar enough is below a chosen miss probability. Survivors are verified on
their full sets.

A bucket of a band is never expanded into its pairs. First each member meets
the bucket's smallest member, which joins most groups. What is still apart in
a bucket is then compared in blocks of bounded size, whose pairs never leave
their task: only links do, one for each two components at most.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import components, small_batches, stored
from sightline.session import kept

# At 80 % similarity a pair shares no band with probability (1 - 0.8 ** 6) ** 40, about 5e-6.
BANDS = 40
BAND_ROWS = 6

# Signature values apart from the bands, compared in batches.
CHECKS = 128
CHECK_BATCH = 16

# A pair is given up once it is similar enough with less than this probability.
MISS = 1e-6

PERCENT = 80

# Rows of a block; two blocks are compared at a time.
BLOCK = 256

# Rows of blocks that a task holds.
AT_ONCE = 8192

# Ids that are sent to every task: 8 bytes each.
BROADCAST_IDS = 500_000

SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, checks binary"
PAIR = "a long, b long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed shingles; the tables are drawn once from a fixed seed."""

    def __init__(self, words: int):
        self.words = words
        rng = np.random.default_rng(20)
        self.bytes = rng.integers(1, 2**63, 256, dtype="uint64") | np.uint64(1)
        self.powers = np.ones(1, dtype="uint64")

    def _powers(self, n: int) -> np.ndarray:
        if n > len(self.powers):
            steps = np.full(max(64, 2 * n), 0x9E3779B97F4A7C15, dtype="uint64")
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype="uint64")
        return self.powers

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; empty without words."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype="uint8")
        blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
        edges = np.concatenate([[True], blank, [True]])
        starts = np.flatnonzero(edges[:-2] & ~edges[1:-1])
        if len(starts) == 0:
            return np.zeros(0, dtype="uint64")
        ends = np.flatnonzero(~edges[1:-1] & edges[2:]) + 1
        lengths = ends - starts
        letters = raw[~blank]
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        hashed = np.add.reduceat(self.bytes[letters] * self._powers(int(lengths.max()))[place], first)
        hashed = _mix(hashed + lengths.astype("uint64"))
        size = min(self.words, len(hashed))
        n = len(hashed) - size + 1
        out = np.full(n, size, dtype="uint64")
        for i in range(size):
            out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + hashed[i : i + n])
        return np.unique(out)


class Signer:
    """Signatures of sets: the least value of every hash function over the set."""

    def __init__(self):
        rng = np.random.default_rng(21)
        count = BANDS * BAND_ROWS + CHECKS
        self.factor = rng.integers(0, 2**32, count, dtype="uint32") | np.uint32(1)
        self.shift = rng.integers(0, 2**32, count, dtype="uint32")
        self.combine = rng.integers(1, 2**63, (BANDS, BAND_ROWS), dtype="uint64") | np.uint64(1)
        self.band = _mix(np.arange(1, BANDS + 1, dtype="uint64"))

    def sign(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each band, and the check values."""
        small = (shingles >> np.uint64(32)).astype("uint32")
        least = np.full(len(self.factor), 0xFFFFFFFF, dtype="uint32")
        for low in range(0, len(small), 256):
            values = small[low : low + 256, None] * self.factor + self.shift
            np.minimum(least, values.min(axis=0), out=least)
        bands = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype("uint64")
        buckets = _mix((bands * self.combine).sum(axis=1, dtype="uint64") ^ self.band)
        # Two bytes tell values apart as well as four but for one case in 65 536.
        return buckets.view("int64"), (_mix(least[BANDS * BAND_ROWS :].astype("uint64")) >> np.uint64(48)).astype("uint16")


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Size, digest, buckets and check values of each document's set; all but the size null for an empty set."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer()
        for batch in batches:
            sizes, digests, bands, checks = [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingler.shingles(text)
                sizes.append(len(own))
                if len(own):
                    buckets, values = signer.sign(own)
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    bands.append(buckets)
                    checks.append(values.tobytes())
                else:
                    digests.append(None)
                    bands.append(None)
                    checks.append(None)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(checks, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands", "checks"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SIGNED)


def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """Fewest matches among n check values with which a pair goes on, for each batch end n.

    With a uniform prior the similarity after m matches of n is
    Beta(m + 1, n - m + 1) distributed, and its chance to be at least t is that
    of at most m successes in n + 1 trials of probability t.
    """
    t, out = percent / 100, {}
    for n in range(CHECK_BATCH, CHECKS + 1, CHECK_BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def surviving(a: np.ndarray, b: np.ndarray, limits: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of rows of ``a`` and ``b`` that no batch gives up, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype="int64")
    for n, least in limits.items():
        part = slice(n - CHECK_BATCH, n)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        go = matches >= least
        alive, matches = alive[go], matches[go]
    return alive, matches


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="uint16").reshape(-1, CHECKS)


def _sizes_fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Sets whose sizes differ too much can't be similar enough."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def compare(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that the sequential comparison doesn't give up."""
    for end in ("a", "b"):
        side = classes.select(
            F.col("rep").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("checks").alias(f"checks_{end}")
        )
        pairs = pairs.join(side, end)
    limits = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(f"n_{end}").to_numpy() for end in ("a", "b")]
                fit = np.flatnonzero(_sizes_fit(*sizes, percent))
                values = [_values(batch.column(f"checks_{end}"))[fit] for end in ("a", "b")]
                yield batch.select(["a", "b"]).take(pa.array(fit[surviving(*values, limits)[0]]))

    return pairs.mapInArrow(run, PAIR)


def _narrowed(rows: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on an id; few ids, counted first, spare the rows a shuffle."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    own = ids.select(F.col(ids.columns[0]).alias(key))
    return rows.join(F.broadcast(own) if few else own, key, how)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with the given ids; rows that are repeated count once."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = _narrowed(texts, "doc_id", ids, "left_semi")
    once = texts.groupBy("doc_id", F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text"))
    return once.select("doc_id", "text")


def verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    texts = texts_of(docs, kept(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()))
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        sets = lru_cache(64)(shingler.shingles)
        for batch in batches:
            good = []
            for x, y in zip(batch["text_a"], batch["text_b"], strict=True):
                x, y = sets(x), sets(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
            yield batch.loc[np.array(good, dtype=bool), ["a", "b"]]

    return both.mapInPandas(run, PAIR)


def bucket_members(classes: DataFrame) -> DataFrame:
    """(bucket, rep, a, n): members of buckets of two and more, the bucket's smallest member, and their number."""
    buckets = classes.select("rep", F.explode("bands").alias("bucket"))
    centres = buckets.groupBy("bucket").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return buckets.join(stored(centres, "centres"), "bucket")


def star_pairs(members: DataFrame) -> DataFrame:
    """Each bucket's members with its smallest one, as (a, b)."""
    return members.where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _blocks(members: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, dealt into blocks of bounded size.

    In each bucket the members of its largest component meet only the others,
    and the others meet each other as well. A bucket of three and more members
    may have pairs that no star covers; smaller ones have none.
    """
    member = members.where("n > 2").select("bucket", "rep").join(groups.select(F.col("node").alias("rep"), "root"), "rep", "left")
    member = stored(member.select("bucket", "rep", F.coalesce("root", "rep").alias("comp")), "comps")
    by_comp = member.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    shape = by_comp.groupBy("bucket").agg(
        F.sum("n").alias("total"), F.max(F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps")
    )
    shape = shape.where("comps > 1").select(
        "bucket", "total", F.col("main.comp").alias("main"), F.col("main.n").alias("n_main")
    )
    apart = member.join(stored(shape, "shapes"), "bucket")

    in_main = F.col("comp") == F.col("main")
    mains = F.ceil(F.col("n_main") / BLOCK).cast("int")
    others = F.ceil((F.col("total") - F.col("n_main")) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.when(in_main, mains).otherwise(others)).cast("int")

    def block(kind: int, x, y):
        return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))

    def each(n, make):
        return F.transform(F.sequence(F.lit(0), n - 1), make)

    small = F.array(block(0, F.lit(0), F.lit(0)))
    main_blocks = each(others, lambda i: block(1, F.col("own"), i))
    other_blocks = F.concat(
        each(mains, lambda i: block(1, i, F.col("own"))),
        each(others, lambda i: block(2, F.least(i, F.col("own")), F.greatest(i, F.col("own")))),
    )
    blocks = F.when(F.col("total") <= 2 * BLOCK, small).when(in_main, main_blocks).otherwise(other_blocks)
    dealt = apart.withColumn("own", own).select("bucket", "rep", "comp", F.explode(blocks).alias("at"))
    return dealt.join(classes.select("rep", "n_shingles", "checks"), "rep")


def _block_of(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    return {
        "key": rows["block"].to_numpy(),
        "comp": rows["comp"].to_numpy(),
        "n": rows["n_shingles"].to_numpy(),
        "checks": np.frombuffer(b"".join(rows["checks"]), dtype="uint16").reshape(-1, CHECKS),
    }


def _apart(rows: dict[str, np.ndarray], percent: int, limits: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (low, high) and matches of the pairs of different components in one block that may be similar."""
    key, found = rows["key"], [np.zeros((3, 0), dtype="int64")]
    for step in range(1, len(key)):
        at = np.flatnonzero(key[:-step] == key[step:])
        if len(at) == 0:
            break
        at = at[rows["comp"][at] != rows["comp"][at + step]]
        at = at[_sizes_fit(rows["n"][at], rows["n"][at + step], percent)]
        alive, matches = surviving(rows["checks"][at], rows["checks"][at + step], limits)
        found.append(np.stack([at[alive], at[alive] + step, matches]))
    low, high, matches = np.concatenate(found, axis=1)
    return low, high, matches


def _by_block(batches: Iterator[pd.DataFrame], at_once: int) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by block, regrouped so that no block is cut."""
    waiting: list[pd.DataFrame] = []
    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= at_once:
            rows = pd.concat(waiting, ignore_index=True)
            last = rows["block"].to_numpy() == rows["block"].iloc[-1]
            yield rows[~last]
            waiting = [rows[last]]
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block")


def block_members(dealt: DataFrame, percent: int) -> DataFrame:
    """The rows of the blocks that are in some pair which the sequential comparison doesn't give up."""
    limits = least_matches(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_block(batches, AT_ONCE):
            if len(rows):
                low, high, _ = _apart(_block_of(rows), percent, limits)
                yield rows.iloc[np.unique(np.concatenate([low, high]))]

    # Two blocks under one hash would only be compared with each other as well.
    rows = dealt.select(F.xxhash64("bucket", "at").alias("block"), "rep", "comp", "n_shingles", "checks")
    return _together(rows).mapInPandas(run, "block long, rep long, comp long, n_shingles long, checks binary")


class _Links:
    """Joins the components of one lot of blocks by links that hold on the full sets."""

    def __init__(self, reps: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], percent: int):
        self.reps, self.comps, self.sets, self.percent = reps, comps, sets, percent
        self.root = {c: c for c in comps.tolist()}
        self.found: list[tuple[int, int]] = []

    def comp(self, place: int) -> int:
        c = self.comps[place].item()
        while self.root[c] != c:
            c = self.root[c]
        return c

    def try_all(self, place: int, others: list[int]) -> None:
        """Link a row to the others that are similar enough and still apart from it."""
        own = self.sets[place]
        sizes = np.array([len(self.sets[o]) for o in others])
        joined = np.concatenate([self.sets[o] for o in others])
        at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
        common = np.add.reduceat(own[at] == joined, np.cumsum(sizes) - sizes, dtype="int64")
        similar = 100 * common >= self.percent * (len(own) + sizes - common)
        for other in np.array(others)[similar].tolist():
            a, b = self.comp(place), self.comp(other)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.found.append((self.reps[place].item(), self.reps[other].item()))

    def run(self, low: np.ndarray, high: np.ndarray, matches: np.ndarray) -> list[tuple[int, int]]:
        order = np.lexsort((high, -matches, low))
        low, high = low[order], high[order]
        cuts = np.flatnonzero(np.diff(low)) + 1
        for place, own in zip(low[np.concatenate([[0], cuts])] if len(low) else [], np.split(high, cuts), strict=False):
            # The likeliest row of each component comes first; if it links, the others needn't be read.
            first: dict[int, int] = {}
            for other in own.tolist():
                if self.comp(other) != self.comp(place):
                    first.setdefault(self.comp(other), other)
            if first:
                self.try_all(place, list(first.values()))
            rest = [o for o in own.tolist() if self.comp(o) != self.comp(place)]
            if rest:
                self.try_all(place, rest)
        return self.found


def block_links(alive: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join components in the blocks, verified on the full sets of the rows."""
    limits = least_matches(percent)
    texts = texts_of(docs, kept(alive.select("rep").distinct()))
    rows = alive.join(texts.withColumnRenamed("doc_id", "rep"), "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for rows in _by_block(batches, 2 * BLOCK):
            if len(rows):
                pairs = _apart(_block_of(rows), percent, limits)
                sets = [shingler.shingles(t) for t in rows["text"]]
                links = _Links(rows["rep"].to_numpy(), rows["comp"].to_numpy(), sets, percent)
                yield pd.DataFrame(links.run(*pairs), columns=["a", "b"], dtype="int64")

    return _together(rows.select("block", "rep", "comp", "n_shingles", "checks", "text")).mapInPandas(run, PAIR)


def classes_of(signs: DataFrame) -> DataFrame:
    """One row per set: (digest, rep, n_shingles, bands, checks), the smallest id standing for all."""
    rest = F.struct("n_shingles", "bands", "checks")
    found = signs.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first(rest).alias("rest")
    )
    return found.select("digest", "rep", "rest.*")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    A-Z count as a-z; words are runs of anything but ASCII white space. A text
    with fewer than ``words`` words is one shingle; one without words, or null,
    is empty and linked with nothing. Sets are linked with
    100 * intersection >= ``percent`` * union; ``component_id`` is the least id
    reachable. Rows that share an id are one document, linked by it; a row
    without an id takes the component of an equal set, else null, and links
    nothing. ``kept`` marks the document whose id is the component's.
    """
    signs, groups = _grouped(docs, words, percent)
    classes, roots = groups
    rows = signs.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    rows = rows.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    component = F.coalesce("root", "rep", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _grouped(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    signs = stored(signed(docs, words), "signs")
    classes = stored(classes_of(signs), "classes")
    members = stored(bucket_members(classes), "members")
    pairs = stored(compare(star_pairs(members), classes, percent), "pairs")
    # An id that stands for several sets joins them.
    edges = kept(verify(pairs, docs, words, percent))
    roots = components(edges)
    alive = stored(block_members(_blocks(members, roots, classes), percent), "alive")
    more = kept(block_links(alive, docs, words, percent))
    if not more.isEmpty():
        roots = components(edges.unionByName(more))
    return signs, (classes, roots)


def keep_one(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; the columns are those of ``docs``.

    Rows without an id stay. Rows that share an id are one document, of which one row stays.
    """
    found = kept(near_duplicates(docs, words, percent).where("doc_id IS NOT NULL").select("doc_id", "kept"))
    gone = found.where("NOT kept").select("doc_id").distinct()
    repeated = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = _narrowed(docs, "doc_id", kept(gone), "left_anti").select(*names)
    repeated = kept(repeated)
    if repeated.isEmpty():
        return rows
    once = _narrowed(rows, "doc_id", repeated, "left_anti").select(*names)
    return once.unionByName(_narrowed(rows, "doc_id", repeated, "left_semi").select(*names).dropDuplicates(["doc_id"]))
