"""Reading and writing the JSON and score payloads of messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.schema import ATTRS, HEADER, SCORED


def parse_header(text: Column) -> Column:
    """Header text -> typed struct; null when the text is not a header."""
    return F.from_json(text, HEADER)


def header_fields(text: Column) -> dict[str, Column]:
    """The header values stored with an entity; the boxes stay text."""
    return {
        "start_frame": F.get_json_object(text, "$.run-frame-index").cast("int"),
        "video": F.get_json_object(text, "$.id.video-url"),
        "boxes_json": F.get_json_object(text, "$.bounding-boxes"),
    }


def render(*columns: Column | str) -> Column:
    """Row -> one JSON object."""
    return F.to_json(F.struct(*columns))


def to_base64(blob: Column) -> Column:
    """base64 text on one line, whatever the session's line length is."""
    return F.translate(F.base64(blob), "\r\n", "")


def score_map(scores: Column) -> Column:
    """Score array -> map of attribute name to score."""
    return F.map_from_arrays(F.array(*[F.lit(name) for name in SCORED]), scores)


def score_columns(scores: Column) -> list[Column]:
    """Score array -> all attribute columns; attributes without a score are 0."""
    place = {name: i for i, name in enumerate(SCORED)}
    zero = F.lit(0.0).cast("float")
    return [
        (F.coalesce(F.get(scores, F.lit(place[name])).cast("float"), zero) if name in place else zero).alias(name)
        for name in ATTRS
    ]


def attribute_vector(prefix: str = "") -> Column:
    """The attribute columns as one array, for comparisons."""
    return F.array(*[F.col(prefix + name) for name in ATTRS])
