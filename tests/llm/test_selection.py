"""Ring sharding, mixing by flow, URL aliases and top-k search."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import mixing, ring, topk, urls
from sightline.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 9, "x") for i, t, s in rows], DOCS)


# Ring.


def _ring(spark, rows, **kw):
    return ring.assign(spark.createDataFrame(rows, "doc_id long, v string"), "doc_id", **kw).collect()


def test_rows_law_and_slots(spark):
    rows = [(i, "x" * (i % 7), None if i % 5 else "a") for i in range(997)] + [(None, None, None)] * 6
    got = ring.shard_documents(_docs(spark, rows)).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    again = ring.shard_documents(_docs(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_few_rows_and_none(spark):
    assert ring.shard_documents(_docs(spark, [])).count() == 0
    got = ring.shard_documents(_docs(spark, [(1, "a", "s"), (1, "a", "s"), (2, None, "s")])).collect()
    assert sorted(r.size for r in got) == [1, 2, 2] and all(r.slot == 0 for r in got)


def _by_hand(counts, shards, load_factor, per_shard):
    """Row by row around the ring: home first, then clockwise to the next shard with room."""
    nodes = ring.virtual_nodes(shards, per_shard, len(counts))
    starts = sorted(nodes)
    home = [starts[max((i for i, s in enumerate(starts) if s <= c), default=len(starts) - 1)] for c in range(len(counts))]
    room, used, waiting, where = ring.capacities(sum(counts), shards, load_factor), [0] * shards, [], []
    order = [c for c in range(len(counts)) if c >= starts[0]] + [c for c in range(len(counts)) if c < starts[0]]
    for c in order:
        for _ in range(counts[c]):
            shard = nodes[home[c]]
            if used[shard] < room[shard]:
                used[shard] += 1
                where.append((c, shard))
            else:
                waiting.append(c)
    for c in waiting:
        at = starts.index(home[c])
        while True:
            at += 1
            shard = nodes[starts[at % len(starts)]]
            if used[shard] < room[shard]:
                used[shard] += 1
                where.append((c, shard))
                break
    return where, used


@pytest.mark.parametrize("load_factor", [1.0, 1.1, 2.0])
def test_layout_follows_the_ring(load_factor):
    rng = random.Random(3)
    counts = [rng.choice([0, 0, 1, 3, 40]) for _ in range(64)]
    ranges = ring.lay_out(np.array(counts), 5, load_factor, 3)
    _, used = _by_hand(counts, 5, load_factor, 3)
    got = Counter()
    for r in ranges:
        got[r.shard] += r.last - r.first + 1
    assert [got[s] for s in range(5)] == used
    assert [r.first for r in ranges] == [0, *[r.last + 1 for r in ranges[:-1]]]


def test_growing_moves_few_rows(spark):
    rows = [(i, "v") for i in range(4000)]
    before = {r.doc_id: r.shard for r in _ring(spark, rows, shards=8, load_factor=1.3)}
    after = {r.doc_id: r.shard for r in _ring(spark, rows, shards=9, load_factor=1.3)}
    assert max(Counter(after.values()).values()) <= 1.3 * 4000 / 9 + 1
    assert sum(before[i] != after[i] for i in before) < 0.3 * 4000


def test_a_key_of_a_third_of_all_rows_is_split(spark):
    rows = [(7, "v")] * 500 + [(i, "v") for i in range(1000)]
    got = _ring(spark, rows, shards=4, load_factor=1.0, cell_rows=50)
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes.values()) == [375] * 4
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(375))


# Mixing.


def test_targets_are_capped_and_reshared():
    sizes = {"a": 10, "b": 500, "c": 490}
    got = mixing.targets(sizes, {"a": 5, "b": 2, "c": 1})
    assert got == pytest.approx({"a": 30, "b": 970 * 2 / 3, "c": 970 / 3})
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 5}) == {"a": 0}


def _cheapest(words, goal, repeats):
    """Least cost over all splits of small whole numbers."""
    patterns = list(words)

    def ways(p, left):
        if p == len(patterns):
            return {tuple(left): 0}
        best = {}
        for amounts in _splits(patterns[p], left, repeats * words[patterns[p]]):
            rest = [n - a for n, a in zip(left, amounts, strict=True)]
            total, n = sum(amounts), words[patterns[p]]
            cost = sum(max(0, min(n, total - r * n)) * r for r in range(repeats))
            for k, v in ways(p + 1, rest).items():
                best[k] = min(best.get(k, v + cost), v + cost)
        return best

    sources = list(goal)

    def _splits(pattern, left, room):
        def walk(i, room):
            if i == len(sources):
                yield []
                return
            for a in range(min(room, left[i]) + 1 if sources[i] in pattern else 1):
                for rest in walk(i + 1, room - a):
                    yield [a, *rest]

        yield from walk(0, room)

    found = ways(0, [round(goal[s]) for s in sources])
    least = min(sum(k) for k in found)
    return least, min(v for k, v in found.items() if sum(k) == least)


@pytest.mark.parametrize("seed", range(6))
def test_flow_has_least_cost(seed):
    rng = random.Random(seed)
    words = {("a",): rng.randint(0, 3), ("a", "b"): rng.randint(1, 3), ("b",): rng.randint(0, 3)}
    goal = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
    taken = mixing.route(words, goal, 3)
    short = sum(goal.values()) - sum(taken.values())
    cost = sum(max(0, min(words[p], taken[p] - r * words[p])) * r for p in words for r in range(3))
    assert (short, cost) == _cheapest(words, goal, 3)


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(5)
    rows = [(i, " w" * rng.randint(0, 60), rng.choice(["a", "b", "c", "hot", "hot", "hot", None])) for i in range(900)]
    rows += [(900 + i, t, "tiny") for i, t in enumerate([None, "", "\u00a0", "x y"])]
    got = mixing.mix_documents(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    own, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        own[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert (source[r.doc_id] is None) or r.source_size > 0
    assert own["tiny"] == 3  # the no-break space is a word, ASCII blanks are none
    names = sorted([s for s in own if s], key=str) + [None]
    assert target == pytest.approx(mixing.targets(own, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}))
    for s in own:
        # Documents are taken whole, so a quota ends within one.
        assert abs(taken[s] - target[s]) <= max(r.size for r in got if source[r.doc_id] == s)
    again = mixing.mix_documents(_docs(spark, rows[::-1]).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mixed_documents_are_repeated_whole(spark):
    rows = [(i, "w " * (i % 9 + 1), "a" if i % 4 else "b") for i in range(100)]
    copies = {r.doc_id: r.taken // r.size for r in mixing.mix_documents(_docs(spark, rows)).collect()}
    docs = _docs(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = mixed.collect()
    assert Counter(r.doc_id for r in found) == {i: n for i, n in copies.items() if n}
    assert all(r.text == rows[r.doc_id][1] and r.shard == 9 and r["size"] == "x" for r in found)


def test_overlapping_sources(spark):
    rows = [(i, 10, ["a"] if i < 50 else ["b", "a", "a"] if i < 80 else None) for i in range(100)]
    plan, sources = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>"))
    taken = mixing.apply_mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>"), plan).collect()
    goal = {r.source: r.target for r in sources.collect()}
    assert sum(goal.values()) == pytest.approx(800)
    assert abs(sum(r.copies * r["size"] for r in taken) - 800) <= 10
    assert all(r.copies == 0 for r in taken if r.sources is None)
    with pytest.raises(ValueError, match="patterns"):
        mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>"), max_patterns=2)


def test_mix_of_nothing(spark):
    assert mixing.mix_documents(_docs(spark, [])).count() == 0
    got = mixing.mix_documents(_docs(spark, [(1, None, None), (1, None, None)])).collect()
    assert [(r["size"], r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


# URLs.

PAGES = "page_id long, url string, html string, host string, root string"
CANONICAL = '<LINK href="{}" class=x rel="nofollow Canonical">'
REFRESH = "<meta http-equiv=refresh content='0; URL={}'>"


def _judge(spark, rows, **kw):
    rows = [(*r, "x", "y") for r in rows]
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, PAGES), **kw).collect()}


def test_rules(spark):
    got = _judge(spark, [
        (1, "HTTP://A.Example.ORG/es/x?q#f", None), (2, "http://example.org/en/12", ""), (3, "http://notexample.org/es/", None),
        (4, "https://x.com/de/", None), (5, "x://com/fr/", None), (6, None, None), (7, "no scheme/de/", None),
        (8, "http://example.org?x", None), (9, "http://org/", None),
    ])
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    assert got[4][2:] == ("com/de/", "block") and got[5] == ("com", "/fr/", "com/fr/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("example.org", "", None, "allow") and got[9][2:] == ("org/", "allow")


def _longest(host, path, rules):
    """The rule of a place, rule by rule."""
    fit = [
        (len(h + p), h + p, v)
        for h, p, v in rules
        if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fit, default=(None, None, "allow"))[1:]


def test_a_table_of_rules_against_rule_by_rule(spark, monkeypatch):
    rng = random.Random(11)
    labels, parts = ["a", "b", "co", "x\U0001f600", ""], ["", "/", "/d", "/d/", "/\U0001f600", "/d/e", "/dd/e/f"]

    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 3)))

    rules = [(host(), rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(400)]
    rules += [(None, "/", "block"), ("a", None, "block"), ("a", "/d", None)] + rules[:30]
    rules += [("hot.net", f"/{n}/", "block") for n in range(500)]
    rows = [(n, f"http://{host()}{rng.choice(parts)}{rng.choice(['', 'x', '?q'])}", None) for n in range(400)]
    rows += [(1000 + n, f"http://w.hot.net/{n}/x", None) for n in range(490, 510)]
    rows += [(2000, None, None), (2001, "", None), (2002, "none", None)] + rows[:20]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = _judge(spark, rows, rules=table)
    assert len(got) == len({r[0] for r in rows})
    for host_, path, rule, verdict in got.values():
        assert (rule, verdict) == _longest(host_, path, rules)
    assert {v[3] for v in got.values()} == {"allow", "block"}
    # A list is judged like its table, whether it is part of the plan or joined.
    whole = [r for r in rules if None not in r][:200]
    in_plan = _judge(spark, rows, rules=whole)
    monkeypatch.setattr(urls, "PLAN_RULES", 10)
    assert _judge(spark, rows, rules=whole) == in_plan
    assert {v[2:] for v in _judge(spark, rows, rules=table.limit(0)).values()} == {(None, "allow")}


def test_aliases_of_blocked_pages(spark):
    got = _judge(spark, [
        (1, "http://a.net/1", CANONICAL.format("http://b.net/1")),
        (2, "http://b.net/1#frag", REFRESH.format("//www.x.com/de/9")),
        (3, "http://a.net/3", CANONICAL.format("/one")),
        (4, "http://a.net/one", None),
        (5, "http://c.org/5", CANONICAL.format("http://b.net/1")),
        (6, "http://a.net/1", None),
        (7, "http://a.net/dir/7?x", CANONICAL.format("../nothing") + CANONICAL.format("mailto:x") + CANONICAL.format("")),
        (8, None, CANONICAL.format("http://b.net/1")),
        (9, "http://d.net/9", None),
    ], redirects=spark.createDataFrame([("http://d.net/9", "http://A.net/1"), (None, "http://q"), ("http://r", None)], "a string, b string"))
    verdicts = {k: v[3] for k, v in got.items()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "block"}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, i) for i in range(5001, 5200)] + [(None, 1), (1, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Top-k.


def _brute(rows, every, k):
    rows = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, (i, v) in enumerate(rows):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(rows) if j != i and n != q)
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("query_bytes", [1 << 20, 300])
def test_topk_against_brute_force(spark, query_bytes):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) if rng.random() < 0.6 else 0.0 for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")]), (650, [float("inf")]), (700, []), (750, [0.5, 0.5]), (None, [1.0])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    got = topk.top_k(topk.quantized(table), table.vec_id % 50 == 0, 5, query_bytes).collect()
    assert {tuple(r) for r in got} == _brute(rows, 50, 5)


def test_topk_of_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.nearest_vectors(table).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.nearest_vectors(table.limit(0)).count() == 0
    big = spark.createDataFrame([(0, [4e6, 1.0]), (1, [4e6, -1.0]), (2, [-4e6, 0.0])], "vec_id long, embedding array<float>")
    found = topk.nearest_vectors(big).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 1024000000**2 - 256 * 256), (2, -(1024000000**2))]


# Repeated rows, wide numbers and pages without a web address.


@pytest.mark.parametrize("seed", range(3))
def test_a_quota_ends_among_repeated_rows(spark, seed):
    """One id that holds most of a source's rows is taken in part, and reruns agree."""
    rows = [(1, "w " * 20, "b")] * 300 + [(100 + i, "w " * (20 + seed), "a") for i in range(400)]
    docs = _docs(spark, rows)
    got = mixing.mix_documents(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    for source_size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == source_size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 20 + seed
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    again = mixing.mix_documents(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns
    assert Counter(r.doc_id for r in whole.collect()) == Counter(
        {i: sum(r.taken // r.size for r in got if r.doc_id == i) for i in {r.doc_id for r in got}}
    )


def test_a_split_cell_is_the_same_however_rows_are_dealt(spark):
    rows = [(7, str(i % 40)) for i in range(400)] + [(i, "x") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, v string")
    results = [
        Counter(map(tuple, ring.assign(df.repartition(n), "doc_id", shards=4, load_factor=1.0, cell_rows=50).collect()))
        for n in (1, 5)
    ]
    assert results[0] == results[1] and sum(results[0].values()) == len(rows)


def test_scores_beyond_a_long(spark):
    far = [(50, [1e30, 0.5]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 1.0]), (4, [1e15, 0.0])]
    got = topk.nearest_vectors(spark.createDataFrame(far, "vec_id long, embedding array<float>")).collect()
    most = 2**63 - 1
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, most), (4, most), (3, 128 * 256), (2, -most - 1)
    ]


def test_pages_without_an_address_and_comments(spark):
    link = '<link rel="canonical" href="https://example.org/es/x">'
    pages = [
        (1, "foo", link),
        (2, "", link),
        (3, "", "plain"),
        (4, "https://a.net/1", f"<!-- {link} -->"),
        (5, "https://a.net/2", link),
        (6, None, link),
        (7, "https://a.net/3", f"<!-- open {link}"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    redirects = spark.createDataFrame([("foo", "https://example.org/es/x"), (None, "b")], "a string, b string")
    got = {r.page_id: r.verdict for r in urls.judge(df, redirects=redirects).collect()}
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "allow"}
    assert urls.judge(df.limit(0)).count() == 0
    clash = redirects.withColumn("page_id", F.lit(1)).withColumn("node", F.lit("x")).withColumn("root", F.lit("y"))
    assert urls.judge(df, redirects=clash).count() == len(pages)
