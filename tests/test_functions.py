from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from sightline.functions import names as N
from sightline.functions import payload as P
from sightline.functions import vectors as V
from sightline.schema import ATTRS, PORTS, SCORED, TOPICS


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_fixed_lists():
    assert len(TOPICS) == 15
    assert len(ATTRS) == len(set(ATTRS)) == 125
    assert len(SCORED) == len(set(SCORED)) == 96 and set(SCORED) < set(ATTRS)
    assert set(PORTS.values()) <= set(TOPICS)


@pytest.mark.parametrize(
    "start, frame, default, compat",
    [
        ("20131220184349", 3495, "20131220184828", "20131220184828"),
        ("20131223235900", 45000, "20131224005900", "20131223245900"),
        ("20131231235959", 25, "20140101000001", "20131231240001"),
        ("20131220xxyyzz", 250, None, "20131220"),
    ],
)
def test_start_time(spark, start, frame, default, compat):
    s, f = F.lit(start), F.lit(frame)
    row = _one(spark, N.start_time(s, f).alias("a"), N.start_time(s, f, compat=True).alias("b"))
    assert row.a == default
    if default is None:
        # Unreadable parts count as 0.
        assert row.b == "00020"
    else:
        assert row.b == compat


def test_video_names(spark):
    v = F.lit("CAM01-20131223151500-20131223152048")
    row = _one(
        spark,
        N.video_part(v, "camera").alias("cam"),
        N.video_part(v, "start").alias("start"),
        N.video_part(v, "end").alias("end"),
        N.video_part(F.lit("20131223151500-20131223152048"), "start", has_camera=False).alias("bare"),
        N.video_part(F.lit("CAM01"), "end").alias("missing"),
        N.entity_id(v, F.lit(7)).alias("id"),
        N.entity_id(F.lit(None).cast("string"), F.lit(None).cast("int")).alias("no_id"),
        N.video_path(F.lit("root"), v).alias("path"),
        N.file_stem(F.lit("/a/b.c/video.one.mp4")).alias("stem"),
        N.store_path(F.lit("/m/"), F.lit("ssd"), F.lit("2018-01-01"), v, F.lit("t"), F.lit(3)).alias("store"),
        N.packed_path(F.lit("/m/v"), F.lit("t"), F.lit(3)).alias("packed"),
    )
    assert (row.cam, row.start, row.end) == ("CAM01", "20131223151500", "20131223152048")
    assert row.bare == "20131223151500" and row.missing is None
    assert row.id == "CAM01-20131223151500-20131223152048_tarid7" and row.no_id == "unknown_tarid-1"
    assert row.path == "root/CAM01/2013-12-23/CAM01-20131223151500-20131223152048.mp4"
    assert row.stem == "video.one"
    assert row.store == "/m/result/ssd/2018-01-01/CAM01-20131223151500-20131223152048/t/3"
    assert row.packed == "/m/v/t.har/3"


@pytest.mark.parametrize(
    "a, b, same",
    [
        ([0.1], [0.10005], True),
        ([0.00001], [-0.00001], False),
        ([0.0], [0.00005], True),
        ([0.1], [0.1002], False),
        ([0.1, 0.2], [0.1], False),
    ],
)
def test_approx_equal(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    assert df.select(V.approx_equal(F.col("a"), F.col("b"))).first()[0] is same


def test_vector_arithmetic(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0])], "a array<double>, b array<double>")
    row = df.select(
        V.add(F.col("a"), F.col("b")).alias("sum"),
        V.div(F.col("a"), F.lit(2)).alias("half"),
        V.mean_abs_diff(F.col("a"), F.col("b")).alias("diff"),
        V.cosine(F.col("a"), F.col("a")).alias("self"),
        V.vectors_match(F.col("a"), F.col("a"), length=2).alias("match"),
        V.vectors_match(F.col("a"), F.col("a")).alias("wrong_length"),
    ).first()
    assert row["sum"] == [4.0, 7.0] and row.half == [0.5, 1.0] and row["diff"] == 2.5
    assert abs(row.self - 1) < 1e-12 and row.match and not row.wrong_length


def test_feature_codec_is_big_endian(spark):
    df = spark.createDataFrame([([1.0, -2.5],), (None,)], "vec array<float>")
    coded = df.withColumn("text", V.encode_feature(F.col("vec"))).withColumn("back", V.decode_feature(F.col("text")))
    first, second = coded.withColumn("raw", F.unbase64("text")).collect()
    assert bytes(first.raw) == struct.pack(">2f", 1.0, -2.5) and first.back == [1.0, -2.5]
    assert second.text is None and second.back is None


def test_base64_stays_on_one_line(spark):
    row = _one(spark, P.to_base64(F.repeat(F.lit("x"), 300).cast("binary")).alias("t"))
    assert len(row.t) == 400 and "\n" not in row.t


def test_scores_fill_their_attributes(spark):
    df = spark.createDataFrame([([float(i) for i in range(96)],)], "s array<double>")
    row = df.select(*P.score_columns(F.col("s"))).first()
    assert list(row.asDict()) == ATTRS
    assert row.gender_male == 0.0 and row.gender_female == 0.0 and row.age_16 == 1.0 and row.shoes_other_color == 95.0
    mapped = df.select(P.score_map(F.col("s"))).first()[0]
    assert mapped["age_16"] == 1.0 and len(mapped) == 96


def test_header(spark):
    text = (
        '{"id":{"video-url":"CAM01-1-2","serial-number":4},"tracklet-number":9,"run-frame-index":77,'
        '"bounding-boxes":[{"x":1,"y":2,"width":3,"height":4}]}'
    )
    fields = P.header_fields(F.lit(text))
    row = _one(spark, *[c.alias(k) for k, c in fields.items()], P.parse_header(F.lit(text)).alias("h"))
    assert row.start_frame == 77 and row.video == "CAM01-1-2"
    assert row.boxes_json == '[{"x":1,"y":2,"width":3,"height":4}]'
    assert row.h["tracklet-number"] == 9 and row.h["bounding-boxes"][0].height == 4
