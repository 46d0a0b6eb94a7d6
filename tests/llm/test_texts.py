"""Languages, near-duplicates, benchmark leaks, and the pipeline of all."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import contamination, language, neardup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, verdict string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None, True, "x") for i, t, lang in rows], DOCS)


SYLLABLES = {"aa": "ba be bi bo bu ka ke ki".split(), "bb": "schn trö ück wald berg ung".split(), "cc": "ção nho lhe rra qui".split()}


def _words(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def _corpus(n=240):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "bb", "cc"])
        rows.append((i, _words(rng, lang, rng.randint(3, 60)), lang))
    return rows


# Languages.


def test_languages_of_held_out_texts(spark):
    rows = _corpus()
    rng = random.Random(1)
    mixed = _words(rng, "aa", 60) + " " + _words(rng, "bb", 40)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (1003, "b64 7f", None), (1004, mixed, None)]
    odd += [(1005, (_words(rng, "cc", 50) + " ") * 2000, None), (None, rows[0][1], "aa"), (1006, "漢字", None)]
    got = {r.doc_id: r for r in language.documents_languages(_docs(spark, rows + odd)).collect()}
    assert len(got) == len(rows) + len(odd)
    held = [i for i, _, _ in rows if got[i].held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]) > 0.95
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred in SYLLABLES and got[1006].lang_pred in SYLLABLES
    assert all(0 <= r.score <= 1 for r in got.values())
    shares = {m.lang: m.share for m in got[1004].languages}
    assert got[1004].lang_pred == "aa" and shares == pytest.approx({"aa": 0.6, "bb": 0.4}, abs=0.05)
    assert got[1005].lang_pred == "cc" and got[1005].score > 0.95


def test_languages_never_use_label_source_or_id(spark):
    rows = _corpus(80)
    model = language.train(_docs(spark, rows).where("doc_id < 60"))
    for shift in (0, 10_000):
        docs = _docs(spark, [(i + shift, t, "zz") for i, t, _ in rows])
        verdict = language.identify(spark, F.col("text"), *model)
        found = sorted((r.doc_id - shift, r.v.lang_pred, r.v.score) for r in docs.select("doc_id", verdict.alias("v")).collect())
        if shift:
            assert found == before
        before = found


def test_nothing_learned_is_undecided(spark):
    assert language.documents_languages(_docs(spark, [])).count() == 0
    got = language.documents_languages(_docs(spark, [(1, "words", None), (1, "words", None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def test_em_against_a_grid_of_proportions():
    rng = np.random.default_rng(3)
    words = np.log(rng.dirichlet([0.3, 0.3], size=80)).astype("float32")
    shares, value = language.proportions(words, rounds=500)
    grid = [np.log(np.exp(words.astype("float64")) @ [p, 1 - p]).sum() for p in np.linspace(0.001, 0.999, 999)]
    assert value == pytest.approx(max(grid), abs=0.2)
    assert shares[0] == pytest.approx(np.linspace(0.001, 0.999, 999)[int(np.argmax(grid))], abs=0.02)


# Near-duplicates.


def _set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def _brute(rows, words):
    sets = [(i, _set(t, words)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets}


def _family(rng, base, n, least, most):
    """Texts with some words of the base replaced."""
    for _ in range(n):
        words = base.split()
        for place in rng.sample(range(len(words)), rng.randint(least, most)):
            words[place] = f"new{rng.randint(0, 10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("block", [256, 4])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(8)
    rows = []
    for size, most in ((60, 6), (40, 3), (25, 9)):
        base = " ".join(f"w{rng.randint(0, 3000)}" for _ in range(150))
        rows += list(_family(rng, base, size, 0, most))
    chain = [f"c{i}" for i in range(150)]
    for step in range(30):
        chain = chain[3:] + [f"c{150 + 3 * step + i}" for i in range(3)]
        rows.append(" ".join(chain))
    rows += ["one two", "one two", "ONE  two", "one two three", "Ä ä", "ä Ä", "", " \t\n", None, None]
    rng.shuffle(rows)
    rows = [(rng.randint(0, 10**9), t) for t in rows]
    got = neardup.near_duplicates(_docs(spark, [(i, t, None) for i, t in rows]), words=4).collect()
    assert {tuple(r) for r in got} == _brute(rows, 4)


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (3, text + " more"), (None, text), (None, "alone"), (5, "other text"), (9, "other text")]
    docs = _docs(spark, [(i, t, None) for i, t in rows])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted(
        [(5, 3, False)] * 3 + [(3, 3, True), (9, 3, False), (None, 3, False), (None, None, True)], key=str
    )
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, None, None]
    twice = neardup.keep_one(_docs(spark, [(1, "a b", None), (1, "a b", None), (2, "a b", None)]))
    assert [r.doc_id for r in twice.collect()] == [1]
    assert neardup.near_duplicates(_docs(spark, [])).count() == 0


def test_posterior_bound_against_simulation():
    limits = neardup.least_matches(80, 1e-3)
    rng = np.random.default_rng(1)
    similarity = rng.random(400_000)
    matches = rng.binomial(64, similarity)
    below = similarity[matches == limits[64] - 1] >= 0.8
    at = similarity[matches == limits[64]] >= 0.8
    assert below.mean() < 2e-3 and at.mean() < 8e-3 and limits[64] < 64 * 0.8
    assert neardup.least_matches(80, 1e-6)[64] < limits[64]


def test_signatures_estimate_similarity():
    signer = neardup.Signer()
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 400, dtype="uint64")
        a = np.concatenate([both, rng.integers(0, 2**63, 50, dtype="uint64")])
        b = np.concatenate([both, rng.integers(0, 2**63, 50, dtype="uint64")])
        errors.append((signer.sign(a)[1] == signer.sign(b)[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


# Leaks.


def _distance(p, t):
    """Least edit distance of the pattern to any passage of the text."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def test_myers_against_the_edit_matrix():
    rng = random.Random(4)
    for _ in range(300):
        p = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        least, end = _distance(p, t)
        if least < len(p):
            assert contamination.best_end(p, t, len(p)) == (least, end)
            assert contamination.best_end(p, t, least - 1) is None


def _mutate(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.choice("sid")
        text[at : at + (kind != "i")] = [] if kind == "d" else [rng.choice("xyz")]
    return "".join(text)


def test_leaks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(contamination, "WINDOW_CHARS", 700)
    rng = random.Random(6)
    items = [(i, " ".join("".join(rng.choices("abcde", k=rng.randint(2, 7))) for _ in range(rng.randint(8, 24)))) for i in range(12)]
    items += [(50, "short"), (51, None), (None, "x" * 40), (52, items[0][1].upper() + "!")]
    rows = []
    for n in range(60):
        filler = [" ".join("".join(rng.choices("abcde", k=5)) for _ in range(rng.randint(0, 150))) for _ in range(2)]
        item = rng.choice(items[:12])[1]
        rows.append((n, f"{filler[0]} -- {_mutate(rng, item, rng.randint(0, 12)).title()}. {filler[1]}", None))
    rows += [(100, None, None), (101, "", None), (102, items[3][1], None), (102, items[3][1], None)]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for item_chars in (1 << 20, 200):
        got = contamination.leaks(_docs(spark, rows), benchmark, error_rate=0.08, item_chars=item_chars).collect()
        expected = set()
        for n, text, _ in rows:
            for i, t in items:
                if i is not None and t and len(contamination.normal(t)) >= 30 and text:
                    p = contamination.normal(t)
                    least, _ = _distance(p, contamination.normal(text))
                    if least <= int(0.08 * len(p)):
                        expected.add((n, i, least))
        assert {(r.doc_id, r.item_id, r.distance) for r in got} == expected
        assert sum(r.doc_id == 102 for r in got) == 2 * len({e for e in expected if e[0] == 102})
    for r in got:
        text = contamination.normal(rows[[n for n, _, _ in rows].index(r.doc_id)][1])
        assert abs((r.stop - r.start) - len(contamination.normal(dict(items)[r.item_id]))) <= r.distance <= len(text)
    clean = contamination.keep_clean(_docs(spark, rows), benchmark, error_rate=0.08)
    assert {r.doc_id for r in clean.collect()} == {n for n, _, _ in rows} - {n for n, _, _ in expected}
    assert contamination.leaks(_docs(spark, rows), benchmark.limit(0)).count() == 0
    assert contamination.keep_clean(_docs(spark, []), benchmark).count() == 0


def test_a_character_is_verified_once_however_often_a_piece_repeats(monkeypatch):
    item = "the quick brown fox jumps over the lazy dog beside the river bank"
    matcher = contamination.Matcher([(1, item)], 0.06, 30)
    piece = contamination.pieces(item, 3)[1][1]
    read, myers = [], contamination.best_end
    monkeypatch.setattr(contamination, "best_end", lambda p, t, most: read.append(len(t)) or myers(p, t, most))
    text = piece * 2000
    assert matcher.search(text) == [] and sum(read) <= len(text)
    # A passage in the middle is found where it lies, and so is the nearer of two.
    near = item.replace("fox", "fax").replace("dog", "dig")
    text = piece * 500 + " " + near + " " + piece * 500 + " " + item.replace("lazy", "lozy") + " z"
    [(_, start, stop, distance)] = matcher.search(text)
    assert distance == 1 and text[start:stop] == item.replace("lazy", "lozy")


def test_leaks_in_megabytes():
    rng = random.Random(3)
    item = " ".join(_words(rng, "aa", 30).split())
    text = _words(rng, "cc", 300_000)
    matcher = contamination.Matcher([(1, contamination.normal(item))], 0.06, 30)
    assert len(text) > 2 << 20 and matcher.search(contamination.normal(text)) == []
    [hit] = matcher.search(contamination.normal(text + " " + _mutate(rng, item, 2) + " " + text))
    assert hit[0] == 1 and hit[3] <= 2


# Pipeline.


def _by_hand(rows, items):
    """What the filtering stages keep, straight from their definitions."""
    lettered = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    roots = {i: root for i, _, root, _ in _brute(lettered, 5)}
    once = [(i, t) for i, t in lettered if roots[i] == i]
    norms = [contamination.normal(t) for _, t in items]
    return {i for i, t in once if not any(p in contamination.normal(t) for p in norms)}


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, t) for i, t, _ in _corpus(120)]
    langs = {i: lang for i, _, lang in _corpus(120)}
    item = _words(rng, "bb", 30)
    rows += [(200, None), (201, "123 456"), (202, rows[5][1] + " " + item), (203, _words(rng, "aa", 80))]
    base = _words(rng, "cc", 120)
    rows += [(300 + n, t) for n, t in enumerate(_family(rng, base, 12, 0, 2))] + [(400, rows[7][1]), (401, rows[7][1].upper())]
    docs = _docs(spark, [(i, t, langs.get(i, "aa")) for i, t in rows]).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b")
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert docs.columns == DOCS.replace(" long", "").replace(" string", "").replace(" boolean", "").split(", "), name
    kept = {r.doc_id for r in docs.collect()}
    assert kept == _by_hand(rows, [(1, item)])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= kept and {r.law for r in got} == {"rows"}
    sizes = [sum(r.shard == s for r in got) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mix", "shards"]


def test_letters_of_all_planes_and_the_best_set(spark):
    kinds = language.character_kinds()
    names, model = ["a"], np.zeros((language.BUCKETS, 1), "float32")
    assert language.judged("\U00030000\U00030001", names, model, kinds)[0] == "a"
    assert language.judged("\U000e0041 \U0010fffd", names, model, kinds)[0] == "und"
    assert not any(chr(c).isalnum() for c in range(language._PLANES, 0x110000))
    from itertools import combinations

    rng = np.random.default_rng(6)
    for _ in range(40):
        n = int(rng.integers(20, 200))
        own = rng.choice(4, size=n, p=rng.dirichlet([0.5] * 4))
        words = (rng.standard_normal((n, 4)) - 8 * (own[:, None] != np.arange(4))).astype("float32")
        cost = language.penalty(n)
        tried = {
            some: language.proportions(words[:, list(some)])[1] - cost * (len(some) - 1)
            for size in range(1, 5)
            for some in combinations(range(4), size)
        }
        got = tuple(np.flatnonzero(language.mixture(words)).tolist())
        assert tried[got] >= max(tried.values()) - 0.5
