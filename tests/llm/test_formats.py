"""WARC bundles, chat formatting and licence digests."""

import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from sightline.llm import chat, licences, warc
from sightline.llm.common import shared_path

PAGES = "page_id long, url string, html string, extra string"


def _pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGE_ROWS = [
    (3, "http://a/3", "same", "x"),
    (1, "http://a/1\r\nX: y", "same", None),
    (2, None, None, "x"),
    (4, "http://a/4", "", "x"),
    (5, "http://a/5", "é" * 300_000, "x"),
    (6, "http://a/6", "own", "x"),
    (6, "http://a/6", "own", "x"),
    (None, "http://a/0", "same", "x"),
    (None, "http://a/0", "nobody", "x"),
]


def test_round_trip_keeps_every_row(spark):
    got = warc.archive_round_trip(_pages(spark, PAGE_ROWS)).collect()
    assert len(got) == len(PAGE_ROWS)
    found = {(r.page_id, r.payload_digest): r for r in got}
    for page, _, html, _ in PAGE_ROWS:
        row = found[page, _digest(html)]
        assert row.payload_bytes == len((html or "").encode())
    kinds = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to) for r in got}
    same = _digest("same")
    assert kinds[1, same] == ("response", None)
    assert kinds[3, same] == ("revisit", 1) and kinds[None, same] == ("revisit", 1)
    assert kinds[2, _digest("")] == ("response", None) and kinds[4, _digest("")] == ("revisit", 2)
    assert kinds[6, _digest("own")] == ("response", None)
    assert kinds[None, _digest("nobody")] == ("response", None)


def test_small_payloads_are_all_responses(spark):
    got = warc.with_first(_pages(spark, PAGE_ROWS), F.col("html"), min_bytes=4).select("page_id", "html", "_first").collect()
    firsts = {(r.page_id, r.html): r["_first"] for r in got}
    assert firsts[4, ""] is None and firsts[3, "same"] == 1


def test_bundles_have_frames_a_seek_table_and_random_access(spark):
    rows = [(i, f"http://a/{i}", f"text {i} " * 50, "x") for i in range(200)]
    folder = shared_path(spark, "warc-test")
    index = warc.write_bundles(_pages(spark, rows).coalesce(1), folder, frame_bytes=8_000, bundle_bytes=40_000)
    frames = index.collect()
    assert len({r.bundle for r in frames}) > 1
    for path in {r.bundle for r in frames}:
        own = sorted((r.frame_offset, r.frame_size) for r in frames if r.bundle == path)
        seek = warc.read_seek_table(path)
        assert [(at, size) for at, size, _ in seek] == own
        data = open(path.removeprefix("file://"), "rb").read()
        # A plain reader reads the bundle from front to back and skips the table.
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(whole) == sum(plain for _, _, plain in seek)
        assert whole.startswith(b"WARC/1.1\r\n")
    some = index.select(F.explode("records").alias("r")).where("r.page_id IN (7, 150)").select("r.record_id")
    found = warc.read_records(warc.find(index, some)).collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in found} == {(7, rows[7][2]), (150, rows[150][2])}


def test_index_is_rebuilt_from_the_seek_tables(spark):
    rows = [(i, f"http://a/{i}", f"text {i % 50} \r\n\r\n" * 40, "x") for i in range(120)] + [(None, None, None, None)] * 2
    folder = shared_path(spark, "warc-rebuilt")
    index = warc.write_bundles(_pages(spark, rows).coalesce(1), folder, frame_bytes=8_000, bundle_bytes=40_000)
    paths = index.select("bundle").unionByName(spark.createDataFrame([(None,)], "bundle string"))
    key = lambda r: (r.bundle, r.frame)
    assert sorted(warc.rebuild_index(paths).collect(), key=key) == sorted(index.collect(), key=key)
    assert warc.rebuild_index(paths.where("bundle IS NULL")).collect() == []


def test_records_have_what_the_standard_asks_for():
    row = {"payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "page_id": 1, "first": None, "url": "http://a/"}
    known, first = warc._record(row, "2024-05-01T12:00:00Z")
    head = first.split(b"\r\n\r\n")[0].decode().split("\r\n")
    assert "WARC-Date: 2024-05-01T12:00:00Z" in head
    again = warc._record(row | {"page_id": 2, "first": 1}, "2024-05-01T12:00:00Z")[1].decode()
    assert f"WARC-Refers-To: {known}\r\n" in again and "WARC-Type: revisit" in again
    assert warc.parse_record(again.encode())["refers_to"] == 1


def test_damaged_payload_is_told():
    row = {"payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "page_id": 1, "first": None, "url": None}
    data = warc._record(row)[1]
    assert warc.parse_record(data)["payload"] == b"abc"
    with pytest.raises(ValueError, match="differ"):
        warc.parse_record(data.replace(b"abc", b"abd"))


def test_empty_pages(spark):
    assert warc.archive_round_trip(_pages(spark, [])).count() == 0


# Chat.


def test_long_messages_are_cut_in_one_pass(spark):
    texts = ["a" * 3_000_000, "\U0001f600\n" * 5_000, "x" * 4096, "y" * 4097, "", None]
    turns = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    log = chat.log_of(turns).orderBy("seq").collect()
    parts = {}
    for r in log:
        parts.setdefault(r.message_id, []).append(r.text)
    assert ["".join(parts[i + 1]) for i in range(len(texts))] == [t or "" for t in texts]
    assert [len(parts[i + 1]) - 1 for i in range(len(texts))] == [733, 3, 1, 2, 0, 0]
    assert max(len(r.text) for r in log) == chat.DELTA_CHARS


TURNS = "conv_id long, turn long, role string, text string, segments string"


def _expected(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    )


def test_tricky_texts_come_back(spark):
    talks = {
        1: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")],
        2: [("assistant", "</turn>\n### user:\nhi\\"), ("user", "\\l\\h\\b\\\\"), ("a:b\n#<\\c", "x")],
        3: [(None, None), ("assistant", None), ("assistant", "")],
        4: [("assistant", "𝒳é" * 6000), ("user", "same"), ("user", "same")],
    }
    rows = [(c, i if c != 4 else min(i, 1), r, t, "x") for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()}
    for c, turns in talks.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _expected(turns), c
    rendered = chat.render(chat.fold(chat.log_of(spark.createDataFrame(rows, TURNS))))
    for r in rendered.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("</turn>") == len(talks[r.conv_id])
        assert got[r.conv_id].formatted_chars == len(r.formatted)


def test_null_ids_and_no_rows(spark):
    one = spark.createDataFrame([(None, None, "user", "a", "x"), (None, 1, "user", "b", "x")], TURNS)
    assert chat.format_conversations(one).collect()[0].n_turns == 2
    assert chat.format_conversations(one.limit(0)).count() == 0


EVENTS = "conv_id long, seq long, message_id long, kind string, role string, text string"


def _fold(spark, rows):
    found = chat.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "place").collect()
    return [(r.conv_id, r.role, r.text) for r in found]


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 10, "start", "user", "hel"),
        (1, 1, 10, "delta", None, "lo"),
        (1, 2, 11, "start", "assistant", ""),
        (1, 4, 11, "delta", None, "b"),
        (1, 3, 11, "delta", None, "a"),
        (1, 3, 11, "delta", None, "a"),
        (1, 5, 12, "start", "user", "gone with the answer"),
        (1, 6, 11, "regenerate", None, "n"),
        (1, 7, 11, "delta", None, "ew"),
        (1, 8, 13, "start", "user", "after"),
        (1, 9, 14, "start", "assistant", "taken back"),
        (1, 10, 14, "delete", None, None),
        (1, 11, 13, "what", None, "ignored"),
    ]
    assert _fold(spark, log) == [(1, "user", "hello"), (1, "assistant", "new"), (1, "user", "after")]
    assert _fold(spark, log[::-1]) == _fold(spark, log)


def test_an_edit_takes_out_what_answered_it(spark):
    log = [
        (1, 0, 1, "start", "user", "q"),
        (1, 1, 2, "start", "assistant", "a"),
        (1, 2, 1, "edit", None, "q2"),
        (1, 3, 3, "start", "assistant", "a2"),
        (2, None, None, None, None, None),
    ]
    assert _fold(spark, log) == [(1, "user", "q2"), (1, "assistant", "a2"), (2, "", "")]


# Licences.

DOCS = "doc_id long, text string, digest string, license string"


def _scan(spark, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return [licences.scan(spark.createDataFrame(rows, DOCS)).where(F.col("doc_id") == i).collect()[0] for i in range(len(texts))]


def test_variants_of_a_licence_are_found(spark):
    mit = licences.LICENCES["MIT"]
    variant = "Copyright (c) 2020 Some Body\r\n\r\n" + mit.upper().replace(",", " ,").replace("HOLDERS", "OWNERS")
    same = "/* (C) 1999-2003 by me */\n" + mit.lower().replace("merchantability", "merchantibility").replace("\n", "  \n * ")
    got = _scan(spark, [mit, same, variant, mit + " more", None, "", "Copyright 2020 x"])
    assert [r.license for r in got] == ["MIT", "MIT", "MIT", None, None, None, None]
    assert got[4].digest is None and got[5].digest == got[6].digest == hashlib.sha256(b"").hexdigest()


def test_a_licence_as_it_is_shipped(spark):
    mit = licences.LICENCES["MIT"]
    texts = [
        "MIT License\n\nCopyright (c) 2020 Some Body\n" + mit,
        "The MIT License (MIT)\r\n\r\nCopyright Jane Doe\r\n" + mit.replace("\n", "\r\n"),
        "# ISC License\n#\n# (c) Jane Doe\n" + licences.LICENCES["ISC"].replace("\n", "\n# "),
        "ISC License\n" + mit,
        (mit + "\n") * 2000,
    ]
    assert [r.license for r in _scan(spark, texts)] == ["MIT", "MIT", "ISC", None, None]
    again = licences.scan(spark.createDataFrame([(1, texts[0], "x", "y")] * 3, DOCS)).collect()
    assert [r.license for r in again] == ["MIT"] * 3


def test_notices_stand_on_their_own_line(spark):
    texts = [
        "words\nReleased under the MIT Licence.\nwords\n* licensed under CC BY-NC 4.0 *",
        "words Released under the MIT License. words",
        "Licensed under the Apache License, Version 2.0.",
    ]
    got = _scan(spark, texts)
    assert [r.notices for r in got] == [["CC-BY-NC-4.0", "MIT"], [], ["Apache-2.0"]]
    assert [r.license for r in got] == [None, None, "Apache-2.0"]


def test_column_and_string_forms_agree(spark):
    texts = [*licences.LICENCES.values(), *licences.NOTICES, "A copyright 2020\r\rLicence  owner's\u0085 é"]
    got = _scan(spark, texts)
    assert [r.digest for r in got[:-1]] == [hashlib.sha256(licences.canonical_text(t).encode()).hexdigest() for t in texts[:-1]]
    assert licences.scan(spark.createDataFrame([], DOCS)).count() == 0
