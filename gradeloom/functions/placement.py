"""Texts that name the school and track a candidate was placed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions._columns import ColumnLike, col, strip

_TRACK_ID = r"(\([0-9]+\))"


def _untag(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<b>")), F.lit("</b>"))


def placement_school(school: ColumnLike) -> Column:
    return F.split_part(_untag(col(school)), F.lit("<br/>"), F.lit(1))


def is_unplaced(school: ColumnLike, track: ColumnLike) -> Column:
    """An empty school or track blanks school, track and county."""
    empty = (placement_school(school) == "") | (col(track) == "")
    return F.coalesce(empty, F.lit(False))


def _has_track(track: Column) -> Column:
    return track.isNotNull() & (F.lower(track) != "nerepartizat")


def bad_placement_track(track: ColumnLike) -> Column:
    """A track text without a bracketed number, or not made of exactly two lines."""
    track = col(track)
    text = _untag(track)
    two_lines = F.size(F.split(text, "<br/>")) == 2
    return F.coalesce(_has_track(track) & (track != "") & ~(text.rlike(_TRACK_ID) & two_lines), F.lit(False))


def placement_track(track: ColumnLike) -> Column:
    """Track name without its number, with the second language if there is one."""
    track = col(track)
    text = _untag(track)
    text = F.replace(text, F.regexp_extract(text, _TRACK_ID, 1), F.lit(""))
    name = strip(F.split_part(text, F.lit("<br/>"), F.lit(1)))
    language = F.split_part(text, F.lit("<br/>"), F.lit(2))
    second = F.when(language.contains("/"), strip(F.split_part(language, F.lit("/"), F.lit(-1))))
    usable = _has_track(track) & (track != "") & ~bad_placement_track(track)
    return F.when(usable, F.concat_ws(", ", name, second))


def old_track(track: ColumnLike) -> Column:
    """Older text: number stripped from the left, second language in brackets."""
    text = col(track)
    name = F.ltrim(_untag(F.split_part(text, F.lit("<br/>"), F.lit(1))), F.lit("() 0123456789"))
    language = F.split_part(text, F.lit("<br/>"), F.lit(2))
    second = F.concat(F.lit(" ("), F.split_part(language, F.lit("/"), F.lit(-1)), F.lit(")"))
    return F.concat(name, F.when(language.contains("/"), second).otherwise(F.lit("")))


def old_track_from_bracket(track: ColumnLike) -> Column:
    """Older text, second form: suffix from the last opening bracket of the second line."""
    text = col(track)
    name = strip(F.split_part(text, F.lit("<br/>"), F.lit(1)))
    suffix = F.split_part(F.split_part(text, F.lit("<br/>"), F.lit(2)), F.lit("("), F.lit(-1))
    return F.concat(name, F.lit(" ("), suffix)
