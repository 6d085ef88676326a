"""Column functions for text and times of segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators that str.strip also takes.
BLANK = r"(?U)[\s\x1c-\x1f]"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+$", "")


def leading_blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.regexp_replace(x, rf"^{BLANK}+", ""))


def trailing_blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.regexp_replace(x, rf"{BLANK}+$", ""))


def milliseconds(seconds: Column) -> Column:
    """Whole milliseconds, cut toward zero."""
    return (seconds * 1000).cast("long")


def srt_time(ms: Column) -> Column:
    """HH:MM:SS,mmm with as many hour digits as it takes."""
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def without_labels(x: Column) -> Column:
    """Text without a leading [SPEAKER_n] and then a leading [label]."""
    return F.regexp_replace(F.regexp_replace(strip(x), r"^\[SPEAKER_\d+\]\s*", ""), r"^\[[^\]]+\]\s*", "")


def path_stem(x: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(x, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def path_suffix(x: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(x, r"([^/]*)$", 1), r".(\.[^.]+)$", 1)


def truthy(x: Column) -> Column:
    """Not null and not zero."""
    return x.isNotNull() & (x != 0)


def json_keeping_nulls(x: Column) -> Column:
    return F.to_json(x, {"ignoreNullFields": "false"})


def json_dropping_nulls(x: Column) -> Column:
    return F.to_json(x)
