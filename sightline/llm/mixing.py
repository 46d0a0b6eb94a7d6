"""Mixing overlapping sources to target weights by min-cost flow.

Documents with the same set of sources form a pattern. Each pattern offers its
words once at no cost and again at growing cost, up to ``max_repeats`` times;
each source asks for its target. The flow of least cost says how many words of
each pattern go to each source, and documents are then selected in a seeded
order until that many words are taken.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import WORD, ranked_copies, stored

MAX_REPEATS = 3
WEIGHTS = (5, 2, 1)

# The graph of sources and patterns is solved on the driver; more are refused.
MAX_PATTERNS = 5_000

# Cells of the seeded order; only rows of the cell where a pattern's quota ends are ranked.
CELLS = 4096


class Network:
    """Min-cost flow by successive cheapest paths; capacities are whole numbers."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _cheapest(self, source: int) -> tuple[dict[int, int], dict[int, int]]:
        cost, came, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in self.edges[a]:
                b = self.to[e]
                if self.room[e] and cost[a] + self.cost[e] < cost.get(b, float("inf")):
                    cost[b], came[b] = cost[a] + self.cost[e], e
                    if b not in queued:
                        queued.add(b)
                        queue.append(b)
        return cost, came

    def run(self, source: int, sink: int) -> None:
        while True:
            cost, came = self._cheapest(source)
            if sink not in cost:
                return
            path, b = [], sink
            while b != source:
                path.append(came[b])
                b = self.to[came[b] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount


def targets(sizes: dict, weights: dict, cap: float = MAX_REPEATS, share: float = 1.0) -> dict:
    """Each source's part of all sizes by weight; what exceeds ``cap`` times its size goes to the others by weight."""
    left, open_, out = share * sum(sizes.values()), dict(weights), {}
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total > cap * sizes[s]]
        if not over:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in over:
            out[s] = float(cap * sizes[s])
            del open_[s]
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def route(pattern_words: dict[tuple, int], goal: dict, repeats: int = MAX_REPEATS) -> dict[tuple, int]:
    """Words to take of each pattern. Repeat r costs r, so repeats are spread before any is stacked."""
    patterns, sources = list(pattern_words), list(goal)
    at = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    net = Network(2 + len(patterns) + len(sources))
    sink = len(net.edges) - 1
    taken = defaultdict(list)
    for i, p in enumerate(patterns):
        for r in range(repeats):
            taken[p].append(net.add(0, 1 + i, pattern_words[p], r))
        for s in p:
            net.add(1 + i, at[s], repeats * pattern_words[p], 0)
    for s in sources:
        net.add(at[s], sink, round(goal[s]), 0)
    net.run(0, sink)
    return {p: sum(net.room[e ^ 1] for e in taken[p]) for p in patterns}


def _fill(short: int, offered: Sequence) -> tuple[list[int], int | None, int]:
    """Offered documents, largest first, as long as they fit; then one more if that comes nearer.

    Repeated rows are offered together. Once no offer fits as a whole, some rows
    of one are taken: its order and their number come beside the orders that are
    taken whole.
    """
    chosen = []
    for row in sorted(offered, key=lambda r: (-r["total"], r["order"])):
        if row["total"] <= short:
            chosen.append(row["order"])
            short -= row["total"]
    rest = sorted((r for r in offered if r["order"] not in chosen), key=lambda r: (r["size"], r["order"]))
    # What is left over or exceeded when this many rows of the offer are taken.
    tries = [(abs(short - n * r["size"]), n, r) for r in rest for n in {short // r["size"], short // r["size"] + 1}]
    _, n, row = min(tries, key=lambda t: (t[0], t[1], t[2]["order"]), default=(0, 0, None))
    if not n:
        return chosen, None, 0
    if n == row["n"]:
        return [*chosen, row["order"]], None, 0
    return chosen, row["order"], n


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))


def _cell() -> Column:
    return F.pmod("order", F.lit(CELLS)).cast("int")


def _pattern() -> Column:
    return F.array_sort(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """One plan row per pattern, whose number is checked, goes to every task."""
    own = plan.withColumnRenamed("pattern", "_pattern")
    return rows.join(F.broadcast(own), F.col("pattern").eqNullSafe(F.col("_pattern"))).drop("_pattern")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    seed: int = 7,
    max_patterns: int = MAX_PATTERNS,
) -> tuple[DataFrame, DataFrame]:
    """What to take of each pattern, and each source's size and target; ``docs`` is (doc_id, size, sources array).

    Sources in order of their code points, null last, weigh ``weights`` in
    turn. A document without sources, or of size 0 or null, is not taken; a
    source named twice counts once. Documents are taken whole; a few of each
    size class fill what is left of a quota, which so ends within one document.
    Rows with equal id and size are planned together, and where a quota ends
    among them, only some are taken. More than ``max_patterns`` patterns are refused, as their graph
    would outgrow the driver.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("size", F.lit(0)).cast("long").alias("size"), _pattern().alias("pattern"))
    # Written once, without texts, repeated rows as one; every pass below is a reduction.
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.col("size") * F.col("n"))
    rows = stored(rows.withColumn("order", _order(seed)), "mix").withColumn("cell", _cell())

    sums = rows.groupBy("pattern").agg(F.sum("total").alias("n")).limit(max_patterns + 1).collect()
    if len(sums) > max_patterns:
        raise ValueError(f"more than {max_patterns} patterns of sources")
    words = {tuple(r["pattern"]): r["n"] for r in sums}
    names = sorted({s for p in words for s in p}, key=lambda s: (s is None, s or ""))
    own = {s: sum(n for p, n in words.items() if s in p) for s in names}
    # Documents of several sources count in each of them; the mix is as large as the documents.
    share = sum(n for p, n in words.items() if p) / (sum(own.values()) or 1)
    goal = targets(own, {s: weights[i % len(weights)] for i, s in enumerate(names)}, repeats, share)
    flow = route(words, goal, repeats)

    whole = {p: min(repeats, flow[p] // n) if n else 0 for p, n in words.items()}
    rest = {p: flow[p] - whole[p] * n for p, n in words.items()}
    quota = spark.createDataFrame([(list(p), r) for p, r in rest.items() if r], "pattern array<string>, rest long")
    cut = {tuple(r["pattern"]): (r["cell"], r["room"]) for r in _cut_cells(rows, quota).collect()}
    cuts = spark.createDataFrame([(list(p), *c) for p, c in cut.items()], "pattern array<string>, cut int, room long")
    inside = {tuple(r["pattern"]): r for r in _cut_orders(_with_plan(rows, cuts)).collect()}
    full = [
        (list(p), c, inside[p]["last"] if p in inside else None, room - (inside[p]["n"] if p in inside else 0))
        for p, (c, room) in cut.items()
    ]
    cuts = spark.createDataFrame(full, "pattern array<string>, cut int, last long, short long")
    extra = {}
    for r in _offers(_with_plan(rows, cuts)).collect():
        extra.setdefault(tuple(r["pattern"]), {}).update({o["order"]: o for o in r["offers"]})
    short = {tuple(p): s for p, _, _, s in full}
    extra = {p: _fill(short[p], list(o.values())) for p, o in extra.items()}

    last = {tuple(p): (c, at) for p, c, at, _ in full}
    none = ([], None, 0)
    plan = spark.createDataFrame(
        [(list(p), int(whole[p]), *last.get(p, (-1, None)), *extra.get(p, none)) for p in words],
        "pattern array<string>, whole int, cut int, last long, extra array<long>, part long, part_rows long",
    )
    sources = spark.createDataFrame([(s, own[s], goal[s]) for s in names], "source string, source_size long, target double")
    return plan, sources


def _cut_cells(rows: DataFrame, quota: DataFrame) -> DataFrame:
    """The cell of the seeded order in which each pattern's quota ends, and the room left before it."""
    sums = _with_plan(rows, quota).groupBy("pattern", "rest", "cell").agg(F.sum("total").alias("n"))
    upto = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("pattern").orderBy("cell")))
    end = F.min(F.struct("cell", (F.col("rest") - F.col("upto") + F.col("n")).alias("room"))).alias("end")
    return upto.where("upto > rest").groupBy("pattern").agg(end).select("pattern", "end.cell", "end.room")


def _cut_orders(rows: DataFrame) -> DataFrame:
    """How far each quota reaches within its cell; ranks about one row in CELLS."""
    upto = F.sum("total").over(Window.partitionBy("pattern").orderBy("order"))
    edge = rows.where(F.col("cell") == F.col("cut")).withColumn("upto", upto).where("upto <= room")
    return edge.groupBy("pattern").agg(F.max("order").alias("last"), F.sum("total").alias("n"))


def _chosen() -> Column:
    before = F.col("cell") < F.col("cut")
    return before | ((F.col("cell") == F.col("cut")) & F.coalesce(F.col("order") <= F.col("last"), F.lit(False)))


def _offers(rows: DataFrame) -> DataFrame:
    """Four documents of each size class that the quota has not reached, to fill what is left of it."""
    behind = rows.where(~_chosen() & (F.col("size") > 0))
    row, by_size = F.struct("order", "size", "n", "total"), F.struct("size", "order")
    four = [F.min(row), F.max(row), F.min_by(row, by_size), F.max_by(row, by_size)]
    return behind.groupBy("pattern", F.floor(F.log2("size")).alias("class")).agg(F.array(*four).alias("offers"))


def apply_mix(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` (doc_id, size, sources and any others) with ``copies``, decided row by row from the plan.

    Only where a quota ends among repeated rows are these numbered, in portions;
    the first by a hash of their columns are taken.
    """
    names = docs.columns
    rows = docs.withColumn("size", F.coalesce("size", F.lit(0)).cast("long")).withColumn("pattern", _pattern())
    rows = _with_plan(rows.withColumn("order", _order(seed)).withColumn("cell", _cell()), plan)
    more = (_chosen() | F.array_contains("extra", F.col("order"))).cast("int")
    copies = F.when(F.col("size") > 0, F.col("whole") + more).otherwise(0).cast("int")
    names = [F.col(f"`{c}`") for c in names]
    # One row per pattern.
    largest = plan.agg(F.max("part_rows")).first()[0]
    if not largest:
        return rows.select(*names, copies.alias("copies"))
    within = F.coalesce(F.col("order") == F.col("part"), F.lit(False))
    mark = F.xxhash64("pattern", "order").alias("_quota")
    some = rows.where(within).select(*names, "whole", "part_rows", mark)
    ranked = ranked_copies(some, "_quota", largest)
    rank = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1))
    ranked = ranked.withColumn("_rank", rank)
    taken = (F.col("whole") + (F.col("_rank") < F.col("part_rows")).cast("int")).cast("int")
    return rows.where(~within).select(*names, copies.alias("copies")).unionByName(ranked.select(*names, taken.alias("copies")))


def sized(docs: DataFrame) -> DataFrame:
    """Documents with their number of words and their one source as a set."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumn("size", size).withColumn("sources", F.array(F.col("source").cast("string")))


def mix_documents(docs: DataFrame) -> DataFrame:
    """Words taken of every document, with its source's size and target."""
    rows = sized(docs).select("doc_id", "size", "sources")
    plan, sources = plan_mix(rows)
    mixed = apply_mix(rows, plan)
    # One row per source, no more than patterns.
    return mixed.join(F.broadcast(sources), F.col("sources")[0].eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    rows = sized(docs.select(*[F.col(f"`{c}`").alias(f"d_{c}") for c in docs.columns], "doc_id", "text", "source"))
    plan, _ = plan_mix(rows.select("doc_id", "size", "sources"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    taken = apply_mix(rows, plan).where("copies > 0").withColumn("copy", copies)
    return taken.select(*[F.col(f"`d_{c}`").alias(c) for c in docs.columns])

