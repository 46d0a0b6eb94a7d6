"""Video names, entity ids, packed times and storage paths, as Column expressions.

A video is named ``CAM-START-END``; START and END are local times packed as
``yyyyMMddHHmmss``. Videos run at 12.5 frames per second.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACKED = "yyyyMMddHHmmss"


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division, rounding toward zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def to_micros(ts: Column) -> Column:
    """Microseconds since the epoch, for both timestamp types."""
    return F.unix_micros(ts.cast("timestamp"))


def video_part(video: Column, part: str, has_camera: bool = True) -> Column:
    """``camera``, ``start`` or ``end`` of a video name; null when the part is missing."""
    parts = ["camera", "start", "end"] if has_camera else ["start", "end"]
    return F.get(F.split(video, "-"), F.lit(parts.index(part)))


def entity_id(video: Column, serial: Column) -> Column:
    """Text id of an entity; an entity without video or serial gets the defaults."""
    return F.concat(
        F.coalesce(video, F.lit("unknown")),
        F.lit("_tarid"),
        F.coalesce(serial, F.lit(-1)).cast("string"),
    )


def frame_seconds(frame: Column) -> Column:
    """Whole seconds from the start of the video to a frame."""
    return int_div(frame.cast("bigint") * 2, 25)


def _digits(text: Column, pos: int, length: int) -> Column:
    return F.coalesce(F.substring(text, pos, length).try_cast("bigint"), F.lit(0).cast("bigint"))


def _two(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def start_time(video_start: Column, frame: Column, compat: bool = False) -> Column:
    """Packed time at which an entity first appears.

    The default rolls over midnight and gives null for an unreadable start.
    ``compat`` carries seconds into minutes into hours only, so an hour can be 24
    or more, and reads an unreadable part as 0.
    """
    seconds = frame_seconds(frame)
    if not compat:
        at = F.try_to_timestamp(video_start, F.lit(PACKED))
        return F.date_format(F.timestamp_add("SECOND", seconds, at), PACKED)
    total = _digits(video_start, 13, 20) + seconds
    minutes = _digits(video_start, 11, 2) + int_div(total, 60)
    hours = _digits(video_start, 1, 10) + int_div(minutes, 60)
    return F.concat(hours.cast("string"), _two(minutes % 60), _two(total % 60))


def time_key(packed: Column, level: str) -> Column:
    """Leading digits that name the year, month, day, hour or minute of a packed time."""
    width = {"year": 4, "month": 6, "day": 8, "hour": 10, "minute": 12}[level]
    return F.substring(packed, 1, width)


def video_path(root: Column, video: Column, extension: str = "mp4") -> Column:
    """``root/cam/yyyy-MM-dd/video.ext``"""
    start = video_part(video, "start")
    day = F.concat_ws("-", F.substring(start, 1, 4), F.substring(start, 5, 2), F.substring(start, 7, 2))
    return F.concat_ws("/", root, video_part(video, "camera"), day, F.concat(video, F.lit(f".{extension}")))


def file_stem(path: Column) -> Column:
    """File name up to its last dot."""
    return F.regexp_extract(path, r"([^/]+)\.[^./]*$", 1)


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def task_dir(root: Column, method: Column, date: Column, video: Column, task: Column) -> Column:
    return F.concat_ws("/", F.concat(root, F.lit("result")), method, date, video, task)


def store_path(root: Column, method: Column, date: Column, video: Column, task: Column, serial: Column) -> Column:
    """``<root>result/<method>/<date>/<video>/<task>/<serial>``; root ends with a slash."""
    return F.concat_ws("/", task_dir(root, method, date, video, task), serial.cast("string"))


def packed_path(video_root: Column, task: Column, serial: Column) -> Column:
    """Path of an entity inside its task's archive."""
    return F.concat(video_root, F.lit("/"), task, F.lit(".har/"), serial.cast("string"))


def plan_label(command: Column) -> Column:
    """Run label stamped with the current time; not repeatable, so never in a checked query."""
    return F.concat(command, F.date_format(F.current_timestamp(), "yyyy-MM-dd-HH-mm-ss"))
