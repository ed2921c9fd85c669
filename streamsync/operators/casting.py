"""Text columns to the types a table stores."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamsync.functions.times import millis_to_utc

_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def check_type(type_name: str) -> str:
    """The lower-case type name, or an error for an unknown one."""
    name = type_name.strip().lower()
    if name not in ("string", "number", "date", "decimal") and not _DECIMAL.fullmatch(name):
        raise ValueError(f"unknown column type {type_name!r}")
    return name


def to_type(text: Column, type_name: str) -> Column:
    """Convert one text column; a text that does not convert gives null.

    ``number`` is a whole number, ``date`` epoch milliseconds shown as the UTC
    wall clock, ``decimal(p,s)`` an exact decimal; ``string`` and plain
    ``decimal`` keep the text.
    """
    name = check_type(type_name)
    if name in ("number", "date"):
        number = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
        return number if name == "number" else millis_to_utc(number)
    if name.startswith("decimal("):
        return text.try_cast(name)
    return text


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace each named text column by its typed value."""
    return df.withColumns({n: to_type(F.col(f"`{n}`"), t) for n, t in types.items()})


def cast_failure(types: Mapping[str, str], key: str | None = None) -> Column:
    """Reason text naming the first column that does not convert, else null.

    For a delete only the key matters.
    """
    reason = F.lit(None).cast("string")
    for name, type_name in reversed(list(types.items())):
        if check_type(type_name) in ("string", "decimal"):
            continue
        text = F.col(f"`{name}`")
        bad = text.isNotNull() & to_type(text, type_name).isNull()
        if key is not None and name != key:
            bad = bad & (F.col("op") != "d")
        reason = F.when(bad, F.lit(f"bad {check_type(type_name)} in {name}")).otherwise(reason)
    return reason
