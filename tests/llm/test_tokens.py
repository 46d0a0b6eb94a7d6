"""Packing of token sequences and alignment of tokenizers."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sightline.llm import alignment, common, packing
from sightline.llm.tokens import ByteBpe, PieceBpe

DOCS = "doc_id long, text string, length string, offset int, sequence_id string, pairs int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], DOCS)


# Tokenizers.


@settings(max_examples=300, deadline=None)
@given(st.text(), st.sampled_from(["", "<|endoftext|>", "<|endoftext|> </s>", "  \n\t", "\U00030000", "'re 12 ß"]))
def test_ranks_give_the_ids_of_the_file(text, more):
    for special in (True, False):
        bpe = BPE[special]
        want = bpe.slow.encode(text + more, add_special_tokens=False).ids
        assert bpe.encode(text + more) == want
        assert b"".join(bpe.bytes[i] for i in want) == (text + more).encode()


BPE = {special: ByteBpe(special=special) for special in (True, False)}


def test_special_strings():
    assert BPE[True].encode("a<|endoftext|>") == [64, 50256]
    assert 50256 not in BPE[False].encode("a<|endoftext|>")


# Packing.


def _item_by_item(lengths, capacity):
    """The same method on single items: bins as lists of lengths."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    bins = []
    while large:
        longest = large.pop(0)
        partner = next((n for n in large if n + longest <= capacity), None)
        if partner is not None:
            large.remove(partner)
        bins.append([longest] + [partner] * (partner is not None))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        room = [(capacity - sum(b), i) for i, b in enumerate(bins) if capacity - sum(b) >= n]
        if room:
            bins[min(room)[1]].append(n)
        else:
            bins.append([n])
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_that_of_single_items(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 7, 30, 100])
    shape = rng.choice([lambda: rng.randint(1, capacity), lambda: min(capacity, 1 + int(rng.expovariate(5 / capacity)))])
    lengths = [shape() for _ in range(rng.choice([1, 10, 200]))]
    groups = packing.plan(Counter(lengths), capacity)
    filled, items = Counter(), Counter()
    for g in groups:
        filled[sum(n * times for n, times in g.items)] += g.bins
        for n, times in g.items:
            items[n] += g.bins * times
    # Bins with equal room are interchangeable, so only how full they are is compared.
    assert filled == Counter(sum(b) for b in _item_by_item(lengths, capacity))
    assert items == Counter(lengths) and max(filled) <= capacity


def test_matching_is_the_largest():
    """As many pairs as any choice of partners gives, by trying all of them."""

    def most(items, capacity):
        if len(items) < 2:
            return 0
        first, rest = items[0], items[1:]
        tries = [1 + most(rest[:i] + rest[i + 1 :], capacity) for i, n in enumerate(rest) if n + first <= capacity]
        return max([most(rest, capacity), *tries])

    rng = random.Random(4)
    for _ in range(60):
        items = [rng.randint(11, 30) for _ in range(7)]
        groups = packing.match_large(Counter(items), 30)
        pairs = sum(g.bins for g in groups if sum(times for _, times in g.items) == 2)
        assert pairs == most(items, 30)


def _check_packing(rows, want, capacity):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(want)
    bins = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values(), default=0) <= capacity
    return len(bins)


def _by_hand(docs, capacity):
    out = []
    for doc_id, text in docs:
        ids = [*BPE[True].slow.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.append((doc_id, i, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def test_documents_in_sequences(spark):
    rng = random.Random(2)
    words = "the of une straße 日本 12 <|endoftext|> x. \n".split(" ")
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)]
    docs += [(7, "again")] * 40 + [(None, None), (None, ""), (3, None), (500, "a b " * 3000), (501, "x" * 31)]
    want = _by_hand(docs, 32)
    rows = packing.pack_documents(_docs(spark, docs), 32).collect()
    n = _check_packing(rows, want, 32)
    assert n == len(_item_by_item([w[3] for w in want], 32)) <= 1.02 * math.ceil(sum(w[3] for w in want) / 32)
    again = packing.pack_documents(_docs(spark, docs[::-1]).repartition(7), 32).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_a_whole_multiple_is_cut_evenly(spark):
    rows = packing.pack_documents(_docs(spark, [(1, " a" * 7)]), 4).collect()
    assert sorted((r.piece, r.start, r.length) for r in rows) == [(0, 0, 4), (1, 4, 4)]


def test_sequences_hold_the_ids(spark):
    docs = [(i, "word " * i) for i in range(40)]
    packed = packing.pack(packing.pieces(_docs(spark, docs), 16), 16)
    seqs = packing.sequences(packed).collect()
    ids = {}
    for s in seqs:
        for p in s.pieces:
            ids.setdefault(p.doc_id, []).append((p.start, s.ids[p.offset : p.offset + p.length]))
        assert sum(p.length for p in s.pieces) == len(s.ids) <= 16
    for i, text in docs:
        assert [t for _, part in sorted(ids[i]) for t in part] == [*BPE[True].encode(text), 0]


def test_packing_empty_and_refused(spark):
    assert packing.pack_documents(_docs(spark, [])).count() == 0
    for length in (0, 9, None):
        with pytest.raises(ValueError, match="no length from 1 to 8"):
            packing.pack(spark.createDataFrame([(1, length)], "id int, length int"), 8)


def test_hot_rows_are_numbered_in_portions(spark):
    rows = spark.createDataFrame([(1, 3)] * 1000 + [(i, 3) for i in range(50)] + [(5, 4), (5, 4)], "id int, g int")
    got = common.ranked_copies(rows, "g", 1050, copies=64, part_rows=8).collect()
    assert max(r._n for r in got) == 64
    for group, n in ((3, 1050), (4, 2)):
        taken = sorted(x for r in got if r.g == group for x in range(r._first, r._first + r._n))
        assert taken == list(range(n))


# Alignment.


def _align_by_hand(docs):
    """Every pair of tokens of every document looked at."""
    a_bpe, b_bpe = BPE[False], PieceBpe()
    found, links = [], Counter()
    for doc_id, text in docs:
        a = a_bpe.slow.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_bpe.encode(text or "")
        spelled = {b"".join(side.bytes[i] for i in ids) for side, ids in ((a_bpe, a), (b_bpe, b))}
        if not text or spelled != {(" " + text).encode()}:
            found.append((doc_id, 0, 0, 0, [], 0, ""))
            continue
        ends = []
        for side, ids in ((a_bpe, a), (b_bpe, b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(side.bytes[i]), i))
                at = own[-1][1]
            ends.append(own)
        over = [(x, y) for x in ends[0] for y in ends[1] if x[0] < y[1] and y[0] < x[1]]
        linked = [(x[2], y[2]) for x, y in over if x[1] == y[1]]
        assert linked == [(x[2], y[2]) for x in ends[0] for y in ends[1] if x[1] == y[1]]
        links.update(linked)
        shared = sorted({x[1] for x in ends[0]} & {y[1] for y in ends[1]})
        groups, low = [], 0
        for high in shared:
            sides = [",".join(str(t[2]) for t in own if low < t[1] <= high) for own in ends]
            groups.append("|".join(sides))
            low = high
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((doc_id, len(a), len(b), len(groups), linked, len(over), digest))
    highest = {}
    for (_, b), n in links.items():
        highest[b] = max(n, highest.get(b, 0))
    return Counter(
        (doc, n_a, n_b, n_g, len(own), over, digest, sum(links[p] == highest[p[1]] for p in own), sum(links[p] for p in own))
        for doc, n_a, n_b, n_g, own, over, digest in found
    )


def _alignment_docs():
    rng = random.Random(5)
    words = ["the", "straße", "日本語", "internationalisation", "12345", "</s>", "<|endoftext|>", "é", "\n", "  ", "☃", "aaaa"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(60)]
    return docs + [(3, "same same")] * 5 + [(None, "the"), (90, None), (91, ""), (92, "a▁b"), (93, "\x00"), (94, " "), (95, "<0x41>")]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("table_rows", [10**6, 0])
def test_alignment_by_brute_force(spark, table_rows):
    docs = _alignment_docs()
    got = alignment.align_documents(_docs(spark, docs).repartition(3), table_rows=table_rows)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == _align_by_hand(docs)


def test_runs_of_long_texts(monkeypatch):
    aligner = alignment.Aligner(BPE[False], PieceBpe())
    texts = [t for _, t in _alignment_docs()] + ["internationalisation straße " * 500, "x" * 2000]
    whole = aligner.documents(texts)
    monkeypatch.setattr(alignment, "RUN_TOKENS", 7)
    parts = aligner.documents(texts)
    for name, values in whole.items():
        assert np.array_equal(values, parts[name]), name


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(_docs(spark, [])).count() == 0
    got = alignment.align_documents(_docs(spark, [(1, None), (1, "")])).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, "", 0, 0)] * 2
