"""Vehicle signal records to 14 text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from streamsync.functions.decoding import fields_once
from streamsync.functions.text import last_segment
from streamsync.functions.times import millis_to_text, now_text
from streamsync.operators.envelope import SKIPPED

# The signal texts looked for, the record's keys, the output columns.
SIGNALS = ("event.suprKnkSrv", "gps.", "rolling.")
KEYS = ("vin", "ts", "ct", "oem", "st", "val", "rc")
PLACE = ("topic", "partition", "offset")
COLUMNS = (
    "data_id", "vin", "st", "value", "ts", "ct", "oem", "rc",
    "sts", "ts_time", "creation_date", "province", "city", "knk_flag",
)


def mentions(value: Column, signals: Sequence[str] = SIGNALS) -> Column:
    """the raw text contains one of the signal texts, anywhere."""
    found = F.lit(False)
    for signal in signals:
        found = found | value.contains(signal)
    return found


def _parse(records: DataFrame, zone: str, deterministic_id: bool) -> DataFrame:
    """P11-P16 over ``raw`` texts with their place in the log."""
    schema = StructType([StructField(k, StringType()) for k in KEYS])
    parsed = records.select(fields_once(F.col("raw"), schema), "raw", *PLACE)
    # Thirteen characters of milliseconds: digits, or a sign and twelve digits.
    stamped = F.col("ts").rlike("^([0-9]{13}|[+-][0-9]{12})")
    millis = F.when(stamped, F.substring("ts", 1, 13).try_cast("bigint"))
    row_id = F.sha2(F.concat_ws("|", *PLACE), 256) if deterministic_id else F.uuid()
    reason = (
        F.when(F.col("raw").isNull(), SKIPPED)
        .when(F.col("st").isNull(), "no signal")
        .when(~F.coalesce(stamped, F.lit(False)), "no event time")
    )
    unknown = F.lit(None).cast("string")
    return parsed.select(
        row_id.alias("data_id"),
        "vin", "st", F.col("val").alias("value"), "ts", "ct", "oem", "rc",
        last_segment(F.col("st")).alias("sts"),
        millis_to_text(millis, zone).alias("ts_time"),
        now_text().alias("creation_date"),
        unknown.alias("province"), unknown.alias("city"), F.lit("N").alias("knk_flag"),
        *PLACE,
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("raw")).alias("raw"),
    )


def _place() -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in PLACE]


def decode(
    log: DataFrame,
    signals: Sequence[str] = SIGNALS,
    zone: str = "Asia/Shanghai",
    deterministic_id: bool = True,
) -> DataFrame:
    """One row per record, with ``reason`` and the raw text of the unusable ones.

    A record that mentions no wanted signal is not parsed but ``skipped``.
    With ``deterministic_id`` the row id is a digest of the record's place in the
    log, so that a repeated batch gives the same ids; otherwise a random UUID.
    """
    text = F.col("value").cast("string")
    raw = F.when(mentions(text, signals), text).alias("raw")
    return _parse(log.select(raw, *_place()), zone, deterministic_id)


def accepted(decoded: DataFrame) -> DataFrame:
    """the usable signal rows, 14 columns."""
    return decoded.where("reason is null").select(*COLUMNS)


def ingest(
    log: DataFrame,
    signals: Sequence[str] = SIGNALS,
    zone: str = "Asia/Shanghai",
    deterministic_id: bool = True,
) -> DataFrame:
    """Raw records to usable signal rows; others are dropped before parsing."""
    text = F.col("value").cast("string")
    wanted = log.where(mentions(text, signals)).select(text.alias("raw"), *_place())
    return accepted(_parse(wanted, zone, deterministic_id))


def quarantined(decoded: DataFrame) -> DataFrame:
    """the unusable records with their raw text and the reason."""
    return decoded.where(F.col("reason") != SKIPPED).select(
        F.col("raw").alias("value"), *PLACE, "reason"
    )


def with_signal(rows: DataFrame, name: str) -> DataFrame:
    """rows with this short signal name."""
    return rows.where(F.col("sts") == name)


def with_full_signal(rows: DataFrame, name: str) -> DataFrame:
    """rows with this full signal name, upper and lower case alike."""
    return rows.where(F.lower("st") == F.lower(F.lit(name)))
