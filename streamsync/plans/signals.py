"""Telemetry queries; the event table re-encoded as signal records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.functions.decoding import once
from streamsync.functions.times import utc_to_millis
from streamsync.operators import telemetry
from streamsync.plans.logs import table

# Columns that neither the clock nor a random number decides.
FIXED = [c for c in telemetry.COLUMNS if c != "creation_date"]


def signal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time as millisecond numbers, or as microsecond text for odd ids.

    Every 13th record has no usable time, every 17th no signal name, every 19th
    is cut off; a fifth of the event types gives signals nobody asked for.
    """
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    millis = utc_to_millis(F.col("ts"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "ts")
    signal = (
        F.when(F.col("event_type") == "click", "gps.lat")
        .when(F.col("event_type") == "view", "rolling.engTrq")
        .when(F.col("event_type") == "purchase", "event.suprKnkSrv.knkRatio")
        .when(F.col("event_type") == "error", "gps.")
        .otherwise("body.door")
    )
    record = F.struct(
        F.concat(F.lit("V"), "user_id").alias("vin"),
        F.when(i % 13 == 0, F.lit("123")).when(i % 2 == 1, micros.cast("string"))
        .otherwise(millis.cast("string")).alias("ts"),
        F.lit("GWM").alias("ct"),
        F.lit("GW").alias("oem"),
        F.when(i % 17 != 0, signal).alias("st"),
        i.cast("string").alias("val"),
        F.when(i % 5 == 0, F.lit("112")).alias("rc"),
        F.when(i % 17 == 0, signal).alias("note"),
    )
    cut = F.expr("rtrim('}', to_json(named_struct('st', 'gps.lon', 'val', event_id)))")
    return e.select(
        once(F.when(i % 19 == 0, cut).otherwise(F.to_json(record))).alias("value"),
        F.lit("signals").alias("topic"),
        (i % 8).cast("int").alias("partition"),
        i.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


SIGNAL_EVENTS = """
signals as (
  select event_id i, 'V' || user_id vin,
    case when event_id%13=0 then '123' when event_id%2=1 then epoch_us(ts)::varchar
         else (epoch_us(ts)//1000)::varchar end ts,
    case event_type when 'click' then 'gps.lat' when 'view' then 'rolling.engTrq'
      when 'purchase' then 'event.suprKnkSrv.knkRatio' when 'error' then 'gps.' else 'body.door' end st,
    case event_type when 'click' then 'lat' when 'view' then 'engTrq'
      when 'purchase' then 'knkRatio' when 'error' then 'gps' else 'door' end sts,
    strftime(ts + interval 8 hour, '%Y-%m-%d %H:%M:%S') ts_time,
    event_id::varchar val, case when event_id%5=0 then '112' end rc
  from events)"""

GOOD = "i%19<>0 and i%17<>0 and i%13<>0 and st<>'body.door'"


def telemetry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.ingest(signal_log(spark, sf_dir)).select(*FIXED)


TELEMETRY_PARSE = f"""with {SIGNAL_EVENTS}
select sha256('signals|' || (i%8) || '|' || i) data_id, vin, st, val as "value", ts, 'GWM' ct, 'GW' oem,
  rc, sts, ts_time, null::varchar province, null::varchar city, 'N' knk_flag
from signals where {GOOD}"""


def telemetry_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 by short name."""
    return telemetry.with_signal(telemetry.ingest(signal_log(spark, sf_dir)), "knkRatio").select(*FIXED)


TELEMETRY_SIGNAL = f"{TELEMETRY_PARSE} and sts = 'knkRatio'"


def telemetry_full_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 by full name in any case."""
    rows = telemetry.ingest(signal_log(spark, sf_dir))
    return telemetry.with_full_signal(rows, "ROLLING.engtrq").select(*FIXED)


TELEMETRY_FULL_SIGNAL = f"{TELEMETRY_PARSE} and lower(st) = 'rolling.engtrq'"


def telemetry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = telemetry.decode(signal_log(spark, sf_dir))
    return telemetry.quarantined(decoded).select("topic", "partition", "offset", "reason")


TELEMETRY_QUARANTINE = f"""with {SIGNAL_EVENTS}
select 'signals' topic, (i%8)::varchar as "partition", i::varchar as "offset",
  case when i%19=0 or i%17=0 then 'no signal' else 'no event time' end reason
from signals where i%19=0 or (st<>'body.door' and (i%17=0 or i%13=0))"""

QUERIES = {
    "telemetry_parse": (telemetry_parse, TELEMETRY_PARSE),
    "telemetry_signal": (telemetry_signal, TELEMETRY_SIGNAL),
    "telemetry_full_signal": (telemetry_full_signal, TELEMETRY_FULL_SIGNAL),
    "telemetry_quarantine": (telemetry_quarantine, TELEMETRY_QUARANTINE),
}
