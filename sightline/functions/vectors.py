"""Vector columns: arithmetic, comparison, similarity and the byte codec."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.payload import to_base64


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def div(a: Column, k: Column) -> Column:
    return F.transform(a, lambda x: x / k)


def approx_equal(a: Column, b: Column, tolerance: float = 1e-4) -> Column:
    """Equal when no element differs in sign and every difference is below the tolerance."""
    same = F.zip_with(a, b, lambda x, y: (x * y >= 0) & (F.abs(x - y) < tolerance))
    return (F.size(a) == F.size(b)) & F.forall(same, lambda ok: F.coalesce(ok, F.lit(False)))


def vectors_match(a: Column, b: Column, length: int = 128, tolerance: float = 1e-6) -> Column:
    """Equality of two feature vectors of a fixed length."""
    close = F.zip_with(a, b, lambda x, y: F.abs(x - y) < tolerance)
    return (F.size(a) == length) & (F.size(b) == length) & F.forall(close, lambda ok: F.coalesce(ok, F.lit(False)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def dissimilarity(a: Column, b: Column) -> Column:
    """1 - cosine. The measure is this library's choice."""
    return 1.0 - cosine(a, b)


def mean_abs_diff(a: Column, b: Column) -> Column:
    """Mean absolute difference of two score vectors. The measure is this library's choice."""
    return _total(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))) / F.size(a)


def pack_series(vectors: pd.Series) -> pd.Series:
    """float array -> big-endian 4-byte floats; a batch is converted at once and cut up."""
    held = vectors[vectors.notna()]
    ends = held.map(len).cumsum() * 4
    flat = np.concatenate([*held, np.empty(0, "float32")]).astype(">f4").tobytes()
    cut = [flat[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends)]
    return pd.Series(cut, index=held.index, dtype=object).reindex(vectors.index).replace({np.nan: None})


pack_floats = F.pandas_udf(pack_series, T.BinaryType())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def unpack_floats(blobs: pd.Series) -> pd.Series:
    """Big-endian 4-byte floats -> float array; a batch is converted at once and cut up."""
    held = blobs[blobs.notna()]
    ends = (held.map(len) // 4).cumsum()
    flat = np.frombuffer(b"".join(held), dtype=">f4").astype("float32")
    cut = [flat[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends)]
    return pd.Series(cut, index=held.index, dtype=object).reindex(blobs.index).replace({np.nan: None})


def encode_feature(vec: Column) -> Column:
    """Feature vector as the base64 text that is stored with an entity."""
    return to_base64(pack_floats(vec))


def decode_feature(text: Column) -> Column:
    return unpack_floats(F.unbase64(text))
