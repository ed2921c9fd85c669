"""Change envelopes: ``{"payload": {"op", "before", "after"}}`` records to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from streamsync.functions.decoding import fields_once

OPS = ("c", "u", "d")
META = ("ts", "topic", "partition", "offset")
SKIPPED = "skipped"
# Columns of decoded records that no column of a table is called.
REASON, RAW = "__reason", "__value"


def clean_names(columns: Sequence[str]) -> list[str]:
    """Trimmed column names; a name that would clash with a metadata column is refused."""
    names = [c.strip() for c in columns]
    taken = {"op", REASON, RAW, *META}
    bad = [n for n in names if not n or n.lower() in taken]
    if bad or len({n.lower() for n in names}) < len(names):
        raise ValueError(f"empty, reserved or repeated column name in {names}")
    return names


def envelope_schema(columns: Sequence[str]) -> StructType:
    """The envelope for a list of columns, every value read as text."""
    image = StructType([StructField(n, StringType()) for n in clean_names(columns)])
    payload = StructType(
        [StructField("op", StringType()), StructField("before", image), StructField("after", image)]
    )
    return StructType([StructField("payload", payload)])


def decode(
    log: DataFrame,
    columns: Sequence[str],
    ops: Sequence[str] = OPS,
    key: str | None = None,
    check: Column | None = None,
) -> DataFrame:
    """Parse each record once and take the row image its operation calls for.

    Creates and updates give the new image, deletes the old one.  There is one row
    per record: ``op``, the columns, the record metadata as text, REASON and RAW.
    REASON is null for a usable row; RAW keeps the raw text
    of the others only.  With ``key`` a row without it is unusable; ``check`` may
    name a further reason from ``op`` and the columns.  A record without a value
    (the tombstone that follows a delete) is ``skipped``.
    """
    names = clean_names(columns)
    parsed = log.select(
        fields_once(F.col("value"), envelope_schema(names)),
        F.col("value").cast("string").alias(RAW),
        F.col("timestamp").cast("string").alias("ts"),
        *(F.col(c).cast("string").alias(c) for c in META[1:]),
    )
    op = F.col("payload.op")
    image = F.when(op == "d", F.col("payload.before")).otherwise(F.col("payload.after"))
    flat = parsed.select(
        op.alias("op"),
        *(image.getField(n).alias(n) for n in names),
        *META,
        F.when(F.col(RAW).isNull(), F.lit(SKIPPED))
        .when(F.col("payload").isNull(), F.lit("unreadable"))
        .when(op.isNull() | ~op.isin(list(ops)), F.lit("unsupported op"))
        .alias(REASON),
        RAW,
    )
    reason = F.col(REASON)
    if key is not None:
        reason = F.coalesce(reason, F.when(F.col(f"`{key}`").isNull(), F.lit("missing key")))
    if check is not None:
        reason = F.coalesce(reason, check)
    return flat.withColumn(REASON, reason).withColumn(
        RAW, F.when(F.col(REASON).isNotNull(), F.col(RAW))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """The usable rows: ``op``, columns, metadata."""
    return decoded.where(F.col(REASON).isNull()).drop(REASON, RAW)


def quarantined(decoded: DataFrame) -> DataFrame:
    """The unusable records with their raw text and the reason."""
    return decoded.where(F.col(REASON) != SKIPPED).select(
        F.col(RAW).alias("value"), *META[1:], F.col(REASON).alias("reason")
    )


def flatten(
    log: DataFrame,
    columns: Sequence[str],
    ops: Sequence[str] = OPS,
    meta: Sequence[str] = META,
) -> DataFrame:
    """``op``, columns and the chosen metadata of every wanted change.

    ``ops=("c",), meta=("ts",)`` is the create-only projection.
    """
    names = clean_names(columns)
    return accepted(decode(log, names, ops)).select("op", *(f"`{n}`" for n in names), *meta)


def sink_columns(write_type: str, columns: Sequence[str]) -> list[str]:
    """P5: the columns a kind of sink stores."""
    names = [f"`{n}`" for n in clean_names(columns)]
    extra = {"hive": ["op", "ts"], "jdbc": ["op"]}
    if write_type.lower() == "file":
        return ["op", *names, *META]
    return [*names, *extra[write_type.lower()]]


def for_sink(changes: DataFrame, write_type: str, columns: Sequence[str]) -> DataFrame:
    """P5: project flat changes to what the sink stores."""
    return changes.select(*sink_columns(write_type, columns))
