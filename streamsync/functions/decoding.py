"""Decoding a record once, however often its fields are used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def once(expression: Column) -> Column:
    """Generator giving the expression's value as a column computed once per row.

    A filter on a projected expression is moved below the projection by the
    optimizer and takes a copy of the expression along, so that the work is done
    twice.  A generator's output cannot be moved that way.
    """
    return F.explode(F.array(expression))


def fields_once(text: Column, schema: StructType) -> Column:
    """The top-level JSON fields as columns, each record parsed once.

    A text that is not JSON gives null fields.
    """
    return F.inline(F.array(F.from_json(text.cast("string"), schema)))
