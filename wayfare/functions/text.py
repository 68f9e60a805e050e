"""Text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.constants import UNSAFE_HTML


def safe_html(html: Column) -> Column:
    """HTML without scripts, styles, event handlers, frames and self-closed links."""
    return reduce(lambda text, unsafe: F.regexp_replace(text, "(?i)" + unsafe, ""), UNSAFE_HTML, html)


def as_map(*columns: str) -> Column:
    """Columns as one map of name to value, all text."""
    pairs = [part for name in columns for part in (F.lit(name), F.col(name).cast("string"))]
    return F.create_map(*pairs)


def as_json(*columns: str) -> Column:
    """Columns as one JSON object of text values."""
    return F.to_json(as_map(*columns))


def fields(line: Column, separator: str = " ") -> Column:
    """Every field of a line, trailing empty ones included."""
    return F.split(line, separator, -1)


def fields_trimmed(line: Column) -> Column:
    """Blank-separated fields without trailing empty ones; an empty line is one empty field."""
    body = F.rtrim(line)
    return (F.when(line == "", F.array(F.lit("")))
            .when(body == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, " ", -1)))


def lines(text: Column) -> Column:
    """Lines of a text as a line reader sees them: a final line break opens no further line."""
    closed = F.when(F.endswith(text, F.lit("\n")) | F.endswith(text, F.lit("\r")),
                    F.regexp_replace(text, r"(\r\n|\n|\r)\z", "")).otherwise(text)
    return F.split(closed, r"\r\n|\n|\r", -1)
