"""Record logs derived from the tables: what a Kafka topic would hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.scratch import file_system, work_dir
from streamsync.sources.readers import LOG_SCHEMA

# Log positions of one key: create, update, delete.
PER_KEY = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Places of the logs that this process has stored, by application, name and state of the tables.
_PLACES: dict[tuple[object, ...], str] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of what lies in the tables' folder: changed tables are read again."""
    fs, place = file_system(spark, sf_dir)
    found = [s for s in fs.listStatus(place) if s.isFile()]
    for folder in (s for s in fs.listStatus(place) if s.isDirectory()):
        found += fs.listStatus(folder.getPath())
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found))


def kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A log as a topic would hold it: made and written once, then read."""
    key = (spark.sparkContext.applicationId, name, _files(spark, sf_dir))
    if key not in _PLACES:
        path = f"{work_dir(spark, 'log')}/{name}"
        build().write.parquet(path)
        _PLACES[key] = path
    return spark.read.schema(LOG_SCHEMA).parquet(_PLACES[key])


def stamp(offset: Column) -> Column:
    """A record time: one second per offset."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return (start + F.make_dt_interval(zero, zero, zero, offset)).cast("timestamp")


def change_log(
    rows: DataFrame, key: str, columns: dict[str, Column], changing: str, topic: str
) -> DataFrame:
    """Change events of a table in one pass over it.

    Every row is created at offset 3k; every third key is updated at 3k+1, its
    ``changing`` column raised by 100; every fifth key is deleted at 3k+2.
    """
    k = F.col(key)
    image = F.struct(*(c.alias(n) for n, c in columns.items()))
    updated = image.withField(changing, columns[changing] + 100)
    none = F.when(F.lit(False), image)
    last = F.when(k % 3 == 0, updated).otherwise(image)

    def event(op: str, before: Column, after: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), before.alias("before"), after.alias("after"))

    events = F.array(
        event("c", none, image),
        F.when(k % 3 == 0, event("u", image, updated)),
        F.when(k % 5 == 0, event("d", last, none)),
    )
    exploded = rows.select(k.alias("k"), F.posexplode(events).alias("step", "payload"))
    offset = F.col("k") * PER_KEY + F.col("step")
    return exploded.where("payload is not null").select(
        F.to_json(F.struct("payload")).alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("k") % 4).cast("int").alias("partition"),
        offset.alias("offset"),
        stamp(offset).alias("timestamp"),
    )


CUSTOMER = ["id", "name", "nation", "segment"]
ORDER = ["id", "customer", "status", "cents", "day"]


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "id": F.col("c_custkey"),
        "name": F.col("c_name"),
        "nation": F.col("c_nationkey"),
        "segment": F.col("c_mktsegment"),
    }
    rows = table(spark, sf_dir, "customer")
    return kept(spark, sf_dir, "customer", lambda: change_log(rows, "c_custkey", columns, "nation", "customer"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    columns = {
        "id": F.col("o_orderkey"),
        "customer": F.col("o_custkey"),
        "status": F.col("o_orderstatus"),
        "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
        "day": F.timestamp_diff("MILLISECOND", epoch, F.col("o_orderdate")),
    }
    rows = table(spark, sf_dir, "orders")
    return kept(spark, sf_dir, "orders", lambda: change_log(rows, "o_orderkey", columns, "cents", "orders"))


# DuckDB texts of the same logs: one row per event, with its columns.
CUSTOMER_EVENTS = """
customer_events as (
  with c as (select c_custkey k, c_name as name, c_nationkey nation, c_mktsegment segment from customer)
  select 'c' op, k, 3*k+0 pos, name, nation, segment from c
  union all select 'u', k, 3*k+1, name, nation+100, segment from c where k%3=0
  union all select 'd', k, 3*k+2, name, case when k%3=0 then nation+100 else nation end, segment
  from c where k%5=0)
"""

ORDER_EVENTS = """
order_events as (
  with o as (select o_orderkey k, o_custkey customer, o_orderstatus status,
                    round(o_totalprice*100)::bigint cents, o_orderdate as day from orders)
  select 'c' op, k, 3*k+0 pos, customer, status, cents, day from o
  union all select 'u', k, 3*k+1, customer, status, cents+100, day from o where k%3=0
  union all select 'd', k, 3*k+2, customer, status, case when k%3=0 then cents+100 else cents end, day
  from o where k%5=0)
"""

META_SQL = """strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts,
  '{topic}' as topic, (k%4)::varchar as "partition", pos::varchar as "offset"
"""
