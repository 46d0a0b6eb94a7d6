"""Models as batch scoring functions over partitions."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators.ranking import HOT_ROWS, hot_keys
from sightline.session import kept


def score_batches(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str,
    name: str,
    gather: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Run a model over Arrow batches; it may return any number of rows per batch.

    ``factory`` builds the model once per Python worker. A worker keeps one
    model under each ``name``; another factory under that name, or one with
    other values inside, replaces it. Select the columns the model reads before
    calling. ``gather`` turns all that the model returns in a task into the
    task's rows.
    """
    model = _per_worker(factory, name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = map(model(), batches)
        yield from gather(made) if gather else made

    return df.mapInPandas(run, schema)


def _per_worker(factory: Callable, name: str) -> Callable:
    content = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def model():
        # A worker serves many tasks, but each task unpickles this function with
        # its own globals; what has to outlive the task is kept with the interpreter.
        models = vars(sys).setdefault("_sightline_models", {})
        if models.get(name, (None,))[0] != content:
            models[name] = content, factory()
        return models[name][1]

    return model


def score_parts(
    df: DataFrame,
    factory: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: T.StructType,
    name: str,
    part: str,
) -> DataFrame:
    """Run a model once over all rows of each ``part``; returns ``part`` and the columns of ``schema``.

    Spark does not know where rows lie that :func:`score_batches` returns. Here
    it does, so what follows and groups by ``part`` shuffles none of the scores.
    A part is held in memory. Workers keep models as they do there.
    """
    model = _per_worker(factory, name)

    def run(rows: pa.Array) -> pa.Scalar:
        made = model()(pa.RecordBatch.from_struct_array(rows)).to_struct_array()
        return pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made)[0]

    score = F.arrow_udf(run, T.ArrayType(schema))
    rows = F.struct(*[c for c in df.columns if c != part])
    return df.groupBy(part).agg(score(rows).alias("_made")).select(part, F.inline("_made"))


def mean_rows(model: Callable[[pd.DataFrame], pd.DataFrame], names: Sequence[str], keys: Sequence[str]) -> Callable:
    """What :func:`mean_vectors` makes of boxes that are all in one frame."""

    def run(boxes: pd.DataFrame) -> pd.DataFrame:
        scores = model(boxes) if len(boxes) else boxes
        if scores.empty:
            return pd.DataFrame(columns=[*keys, "n_samples", "scores"])
        return _means(_sums(scores, names, keys), keys)

    return run


def _sums(scores: pd.DataFrame, names: Sequence[str], keys: Sequence[str]) -> pd.DataFrame:
    values = scores[list(names)].to_numpy("float64")
    group = scores.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
    order = np.arange(len(group))
    if (np.diff(group) < 0).any():
        order = np.argsort(group, kind="stable")
        group, values = group[order], values[order]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    out = scores[list(keys)].iloc[order[starts]].reset_index(drop=True)
    out["n"] = np.diff(starts, append=len(order))
    # Null where no score is missing.
    out["counts"] = None
    missing = np.isnan(values)
    if missing.any():
        values = np.where(missing, 0.0, values)
        counts = np.add.reduceat((~missing).astype("int64"), starts)
        full = (counts == out["n"].to_numpy()[:, None]).all(axis=1)
        out["counts"] = [None if f else c for f, c in zip(full, counts, strict=True)]
    out["sums"] = list(np.add.reduceat(values, starts))
    return out[[*keys, "n", "sums", "counts"]]


def _key(rows: pd.DataFrame, keys: Sequence[str], at: int) -> tuple:
    return tuple(None if pd.isna(v) else v for v in (rows[k].iloc[at] for k in keys))


def _counted(n: int, counts, width: int) -> np.ndarray:
    return np.full(width, n, dtype="int64") if counts is None else counts


def _means(parts: pd.DataFrame, keys: Sequence[str]) -> pd.DataFrame:
    """Sums of whole keys -> their means; null where a score is missing in all boxes."""
    out = parts[list(keys)].reset_index(drop=True)
    out["n_samples"] = parts["n"].to_numpy("int64")
    scores = list(np.stack(parts["sums"].to_list()) / out["n_samples"].to_numpy()[:, None])
    for i, (sums, counts) in enumerate(zip(parts["sums"], parts["counts"], strict=True)):
        if counts is not None:
            scores[i] = [s / c if c else None for s, c in zip(sums.tolist(), counts.tolist(), strict=True)]
    out["scores"] = pd.Series(scores, dtype=object)
    return out


def _gather_means(keys: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Means of a task's keys, whose rows come one key after the other; the last key of a batch may go on in the next."""

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for part in parts:
            if part.empty:
                continue
            if last is not None and _key(last, keys, 0) == _key(part, keys, 0):
                n, sums, counts = (last[c].iloc[0] for c in ("n", "sums", "counts"))
                more, added, known = (part[c].iloc[0] for c in ("n", "sums", "counts"))
                if counts is not None or known is not None:
                    counts = _counted(n, counts, len(sums)) + _counted(more, known, len(sums))
                whole = part.iloc[:1].copy()
                whole["n"], whole["sums"], whole["counts"] = n + more, [sums + added], [counts]
                part = pd.concat([whole, part.iloc[1:]], ignore_index=True)
            elif last is not None:
                yield _means(last, keys)
            last = part.iloc[-1:]
            if len(part) > 1:
                yield _means(part.iloc[:-1], keys)
        if last is not None:
            yield _means(last, keys)

    return gather


def mean_vectors(
    boxes: DataFrame,
    factory: Callable,
    names: Sequence[str],
    keys: Sequence[str],
    name: str,
    hot_rows: int = HOT_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """(keys, n_samples, scores): the mean of every score over the boxes of a key, as one array.

    ``factory`` is a recognizer's; it returns rows with the keys of its boxes,
    in their order. The boxes of a key meet before they are scored, so that
    short boxes are shuffled and not their many scores, and a task returns
    means. Only the boxes of a key with more than about ``hot_rows`` are scored
    wherever they lie, and their sums are shuffled. ``probe`` holds the keys of
    at least the same rows and is cheaper to read, see
    :func:`~sightline.operators.ranking.number_rows`. Missing scores don't
    count; a score that is missing in all boxes is null.
    """
    names, keys = list(names), list(keys)

    def build():
        model = factory()

        def sums(batch: pd.DataFrame) -> pd.DataFrame:
            scores = model(batch)
            if scores.empty:
                return pd.DataFrame(columns=[*keys, "n", "sums", "counts"])
            return _sums(scores, names, keys)

        return sums

    schema = ", ".join(f"{k} {boxes.schema[k].dataType.simpleString()}" for k in keys)

    def small(df: DataFrame) -> DataFrame:
        met = df.repartition(*keys).sortWithinPartitions(*keys)
        return score_batches(met, build, f"{schema}, n_samples long, scores array<double>", name, _gather_means(keys))

    hot = hot_keys(boxes if probe is None else probe, keys, hot_rows)
    if hot is None:
        return small(boxes)
    boxes = kept(boxes)
    match = [F.col(f"b.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    cold, large = (boxes.alias("b").join(hot.alias("h"), match, how) for how in ("left_anti", "left_semi"))
    parts = score_batches(large, build, f"{schema}, n long, sums array<double>, counts array<long>", name)
    return small(cold).unionByName(_sum_parts(parts, len(names), keys))


def _sum_parts(parts: DataFrame, width: int, keys: Sequence[str]) -> DataFrame:
    """Means of keys whose sums come from many tasks."""
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    none = lambda zero: F.array_repeat(zero, width)
    sums = F.when(F.size("parts") == 1, F.get("parts", F.lit(0)).sums).otherwise(
        F.aggregate("parts", none(F.lit(0.0)), lambda t, p: add(t, p.sums))
    )
    counted = F.aggregate(
        "parts", none(F.lit(0).cast("long")), lambda t, p: add(t, F.coalesce(p.counts, F.array_repeat(p.n, width)))
    )
    counts = F.when(F.exists("parts", lambda p: p.counts.isNotNull()), counted)
    known = F.zip_with("sums", "counts", lambda s, c: F.when(c > 0, s / c))
    scores = F.when(F.col("counts").isNull(), F.transform("sums", lambda s: s / F.col("n_samples"))).otherwise(known)
    return (
        parts.groupBy(*keys)
        .agg(F.sum("n").alias("n_samples"), F.collect_list(F.struct("n", "sums", "counts")).alias("parts"))
        .select(*keys, "n_samples", sums.alias("sums"), counts.alias("counts"))
        .select(*keys, "n_samples", scores.alias("scores"))
    )


def from_vectors(factory: Callable, names: Sequence[str], column: str = "scores") -> Callable:
    """A model that reads named scores, fed from one array column."""
    names = list(names)

    def build():
        model = factory()

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            values = np.stack(rows[column].to_list()) if len(rows) else np.empty((0, len(names)))
            scores = pd.DataFrame(values.astype("float64"), columns=names)
            return model(pd.concat([rows.drop(columns=column).reset_index(drop=True), scores], axis=1))

        return run

    return build


def _with_keys(boxes: pd.DataFrame, keys: Sequence[str], scores: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([boxes[list(keys)].reset_index(drop=True), scores], axis=1)


def stand_in_recognizer(
    names: Sequence[str], keys: Sequence[str] = ("entity", "idx")
) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Repeatable stand-in for an attribute network: whole scores 0..999 from the box alone."""

    def build():
        steps = np.arange(len(names), dtype="int64") * 13

        def score(boxes: pd.DataFrame) -> pd.DataFrame:
            base = (boxes.x * 31 + boxes.y * 17 + boxes.w * 7 + boxes.h * 3).to_numpy("int64")
            scores = (base[:, None] + steps[None, :]) % 1000
            return _with_keys(boxes, keys, pd.DataFrame(scores.astype("float64"), columns=list(names)))

        return score

    return build


def zero_recognizer(
    names: Sequence[str], keys: Sequence[str] = ("entity", "idx")
) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Stand-in that scores every attribute 0."""

    def build():
        return lambda boxes: _with_keys(boxes, keys, pd.DataFrame(0.0, index=range(len(boxes)), columns=list(names)))

    return build


TRACKS = "video string, serial long, num long, start_frame long, n_boxes long"


def stand_in_tracker() -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Repeatable stand-in for a tracker: 3..32 entities per video, each with 1..31 boxes."""

    def build():
        def track(videos: pd.DataFrame) -> pd.DataFrame:
            mark = videos.video.str.split("-").str[1].astype("int64") % 97
            num = 3 + mark % 30
            out = videos[["video"]].assign(mark=mark, num=num).loc[videos.index.repeat(num)]
            serial = out.groupby("video").cumcount().astype("int64")
            return pd.DataFrame({
                "video": out.video,
                "serial": serial,
                "num": out.num,
                "start_frame": 1 + (out.mark * 31 + serial * 17) % 10_000,
                "n_boxes": 1 + (out.mark + serial * 7) % 31,
            })

        return track

    return build


def stand_in_extracter(
    length: int = 128, keys: Sequence[str] = ("entity", "idx")
) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Repeatable stand-in for a feature network: a vector of fixed length for every box."""

    def build():
        steps = np.arange(length, dtype="int64")

        def extract(boxes: pd.DataFrame) -> pd.DataFrame:
            base = (boxes.x * 31 + boxes.y * 17 + boxes.w * 7 + boxes.h * 3).to_numpy("int64")
            vecs = ((base[:, None] + steps[None, :]) % 256 / 256).astype("float32")
            return _with_keys(boxes, keys, pd.DataFrame({"vec": list(vecs)}))

        return extract

    return build


def stand_in_reider(
    names: Sequence[str], keys: Sequence[str] = ("entity", "idx"), k: int = 10
) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Repeatable stand-in for re-identification: ``k`` ids below 10 000 from the first and the last score."""

    def build():
        def rank(rows: pd.DataFrame) -> pd.DataFrame:
            first, last = (np.floor(rows[n].to_numpy("float64")).astype("int64") for n in (names[0], names[-1]))
            ids = ((first * 31 + last)[:, None] + np.arange(k, dtype="int64") * 7) % 10_000
            return _with_keys(rows, keys, pd.DataFrame({"ids": list(ids)}))

        return rank

    return build


DETECTIONS = "id long, label string, boxes array<struct<x:long,y:long,w:long,h:long,score:double>>"


def stand_in_detector(labels: Sequence[str] = ("person", "car", "bag")) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """Repeatable stand-in for a detector: a label and 0 to 3 boxes for every image (id, width, height)."""

    def build():
        def detect(images: pd.DataFrame) -> pd.DataFrame:
            mark = images.id.to_numpy("int64")
            boxes = [
                [
                    {"x": int(m + i) % int(w), "y": int(m * 3 + i) % int(h), "w": 10 + i, "h": 20 + i, "score": (m + i) % 100 / 100}
                    for i in range(m % 4)
                ]
                for m, w, h in zip(mark.tolist(), images.width, images.height, strict=True)
            ]
            return pd.DataFrame({"id": mark, "label": [labels[m % len(labels)] for m in mark], "boxes": boxes})

        return detect

    return build
