"""Frames, clocks and sensor units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kilometres in a mile.
MILE = 1.60934


def clock_seconds(text: Column) -> Column:
    """HH:MM:SS as seconds."""
    p = F.split(text, ":")
    return p[0].cast("long") * 3600 + p[1].cast("long") * 60 + p[2].cast("long")


def frame_clock(frame: Column, fps: float = 29.97) -> Column:
    """A frame as HH:MM:SS.mmm."""
    s = frame / F.lit(fps)
    return F.format_string("%02d:%02d:%06.3f", F.floor(s / 3600), F.floor(s / 60) % 60, s - F.floor(s / 60) * 60)


def frame_minutes(frame: Column, fps: float = 29.97, colon: bool = True) -> Column:
    """A frame as MMM:SS or MMMSS, cut off to whole seconds."""
    s = F.floor(frame / F.lit(fps))
    return F.format_string("%03d:%02d" if colon else "%03d%02d", F.floor(s / 60), s % 60)


def clock_offsets(first: Column, other: Column) -> Column:
    """How many seconds a camera's clock is ahead of the first camera's."""
    return clock_seconds(other) - clock_seconds(first)


def video_frame(game_frame: Column, first_start: float, first_end: float, second_start: float, fps: float = 29.97) -> Column:
    """The video frame of a frame counted over both halves; the first half includes its last frame."""
    length = int((first_end - first_start) * fps)
    return F.when(game_frame <= length, game_frame + int(first_start * fps)).otherwise(game_frame - length - 1 + int(second_start * fps)).cast("long")


def frame_timestamp(frame: Column, start: Column, fps: float = 29.97) -> Column:
    """The instant of a frame of a video that began at `start`; null stays null."""
    return F.timestamp_micros((F.unix_micros(start) + F.round(frame / F.lit(fps) * 1_000_000)).cast("long"))


def local_timestamp(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss", offset: str = "+08:00") -> Column:
    """A local time of a fixed offset as an instant; null if it doesn't parse."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(pattern)), offset)


def kmh(speed: Column, unit: Column) -> Column:
    """A speed in km/h; units are trimmed and upper-cased, miles an hour are converted."""
    return F.when(F.upper(F.trim(unit)) == "MPH", speed * MILE).otherwise(speed)


def chapter(name: Column) -> tuple[Column, Column]:
    """(group, number) of a chaptered file name GXccbbbb; other names are their own group, number 0."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    hit = stem.rlike(r"(?i)^GX\d{2}\d{4}$")
    return F.when(hit, F.substring(stem, 5, 4)).otherwise(stem), F.when(hit, F.substring(stem, 3, 2).cast("int")).otherwise(0)


def padded(start: Column, end: Column, last: Column, pad: int = 75) -> tuple[Column, Column]:
    """A span widened by `pad` frames, held within [0, last]."""
    return F.greatest(start - pad, F.lit(0)), F.least(end + pad, last)
