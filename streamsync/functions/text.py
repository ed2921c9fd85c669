"""Text splitting with Java ``String.split`` results."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(text: Column, separator: str) -> Column:
    """Split on one character and drop trailing empty parts only.

    Leading and inner empty parts stay, an empty text gives one empty part, and
    a text made of separators only gives no part at all.
    """
    body = F.rtrim(text, F.lit(separator))
    only_separators = (F.length(text) > 0) & (F.length(body) == 0)
    pattern = separator if separator == " " else re.escape(separator)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(body, pattern))


def without_empty_tail(parts: Column) -> Column:
    """The same for a split on runs of separators, given its parts.

    Runs leave one empty part at the end at most, and two empty parts for a text
    made of separators only.  A single part is a text without any separator.
    """
    count = F.size(parts)
    ended = F.element_at(parts, -1) == ""
    nothing = (count == 2) & (F.element_at(parts, 1) == "")
    return (
        F.when((count == 1) | ~ended, parts)
        .when(nothing, F.array().cast("array<string>"))
        .otherwise(F.slice(parts, F.lit(1), count - 1))
    )


def last_segment(text: Column, separator: str = ".") -> Column:
    """The last part of ``java_split``, or the text itself when there is none."""
    body = F.rtrim(text, F.lit(separator))
    only_separators = (F.length(text) > 0) & (F.length(body) == 0)
    return F.when(only_separators, text).otherwise(F.substring_index(body, separator, -1))
