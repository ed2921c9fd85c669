"""Change-data-capture queries on batch logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.operators import casting, changes, envelope, offsets
from streamsync.plans.logs import (
    CUSTOMER,
    CUSTOMER_EVENTS,
    META_SQL,
    ORDER,
    ORDER_EVENTS,
    customer_log,
    order_log,
    table,
)

ORDER_TYPES = {
    "id": "number", "customer": "number", "status": "string", "cents": "decimal(18,2)", "day": "date",
}


def cdc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.flatten(customer_log(spark, sf_dir), CUSTOMER)


CUSTOMER_META = META_SQL.format(topic="customer")

CDC_FLATTEN = f"""with {CUSTOMER_EVENTS}
select op, k::varchar id, name, nation::varchar nation, segment, {CUSTOMER_META} from customer_events"""


def cdc_create_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.flatten(order_log(spark, sf_dir), ORDER, ops=("c",), meta=("ts",))


CDC_CREATE_ONLY = f"""with {ORDER_EVENTS}
select op, k::varchar id, customer::varchar customer, status, cents::varchar cents,
  epoch_ms(day)::varchar as day, strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts
from order_events where op = 'c'"""


def damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer log with cut texts, snapshot reads, lost old images and tombstones."""
    log = customer_log(spark, sf_dir)
    p = F.col("offset")
    value = F.col("value")
    damaged = (
        F.when(p % 17 == 0, F.lit(None))
        .when(p % 7 == 0, F.expr("substr(value, 1, 30)"))
        .when(p % 11 == 0, F.regexp_replace(value, '"op":"[cud]"', '"op":"r"'))
        .when(p % 3 == 2, F.regexp_replace(value, '"before":[{].*[}]', '"before":null}}'))
        .otherwise(value)
    )
    return log.withColumn("value", damaged)


DAMAGED_EVENTS = f"""{CUSTOMER_EVENTS},
images as (
  select *, '{{"id":' || k || ',"name":"' || name || '","nation":' || nation || ',"segment":"' || segment || '"}}' img,
    '{{"id":' || k || ',"name":"' || name || '","nation":' || (nation-100) || ',"segment":"' || segment || '"}}' old
  from customer_events),
texts as (
  select *, case op when 'c' then '{{"payload":{{"op":"c","after":' || img || '}}}}'
    when 'u' then '{{"payload":{{"op":"u","before":' || old || ',"after":' || img || '}}}}'
    else '{{"payload":{{"op":"d","before":' || img || '}}}}' end txt
  from images)"""


def cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.quarantined(envelope.decode(damaged_log(spark, sf_dir), CUSTOMER, key="id"))


CDC_QUARANTINE = f"""with {DAMAGED_EVENTS}
select case when pos%7=0 then substr(txt,1,30)
    when pos%11=0 then regexp_replace(txt,'"op":"[cud]"','"op":"r"')
    else '{{"payload":{{"op":"d","before":null}}}}' end as "value",
  'customer' as topic, (k%4)::varchar as "partition", pos::varchar as "offset",
  case when pos%7=0 then 'unreadable' when pos%11=0 then 'unsupported op' else 'missing key' end reason
from texts where pos%17<>0 and (pos%7=0 or pos%11=0 or op='d')"""


def cdc_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.accepted(envelope.decode(damaged_log(spark, sf_dir), CUSTOMER, key="id"))


CDC_ACCEPTED = f"""with {CUSTOMER_EVENTS}
select op, k::varchar id, name, nation::varchar nation, segment, {CUSTOMER_META} from customer_events
where pos%17<>0 and pos%7<>0 and pos%11<>0 and op<>'d'"""


def cdc_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = envelope.flatten(order_log(spark, sf_dir), ORDER)
    typed = casting.cast_columns(flat, ORDER_TYPES)
    return typed.withColumn("cents", F.col("cents").cast("bigint")).select("op", *ORDER, "offset")


CDC_TYPED = f"""with {ORDER_EVENTS}
select op, k as id, customer, status, cents, day, pos::varchar as "offset" from order_events"""


def cdc_bad_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status text read as a number: every create and update is unusable, deletes are not."""
    types = {**ORDER_TYPES, "status": "number"}
    check = casting.cast_failure(types, "id")
    decoded = envelope.decode(order_log(spark, sf_dir), ORDER, key="id", check=check)
    return decoded.groupBy(F.coalesce(envelope.REASON, F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


CDC_BAD_TYPES = f"""with {ORDER_EVENTS}
select case when op='d' then 'good' else 'bad number in status' end reason, count(*) n
from order_events group by 1"""


def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = envelope.flatten(customer_log(spark, sf_dir), CUSTOMER)
    return changes.current_rows(flat, "id", CUSTOMER)


CDC_CURRENT_STATE = """
select c_custkey::varchar id, c_name as name,
  (case when c_custkey%3=0 then c_nationkey+100 else c_nationkey end)::varchar nation, c_mktsegment segment
from customer where c_custkey%5<>0"""


def cdc_last_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each order by record time, deletes included."""
    flat = envelope.flatten(order_log(spark, sf_dir), ORDER)
    columns = ["id", "op", "cents", "offset"]
    return changes.last_per_key(flat, "id", columns, one_partition_per_key=False)


CDC_LAST_CHANGE = f"""with {ORDER_EVENTS}
select k::varchar id, op, cents::varchar cents, pos::varchar as "offset" from order_events
qualify row_number() over (partition by k order by pos desc) = 1"""


def cdc_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of their user, a third of them of one user: last event of each."""
    hot = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    payload = F.struct(
        F.lit("u").alias("op"), F.struct(hot.alias("id"), F.col("event_type").alias("kind")).alias("after")
    )
    log = table(spark, sf_dir, "events").select(
        F.to_json(F.struct(payload.alias("payload"))).alias("value"),
        F.lit("users").alias("topic"),
        (hot % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    flat = envelope.flatten(log, ["id", "kind"], meta=("partition", "offset"))
    return changes.last_per_key(flat, "id")


CDC_HOT_KEYS = """
select op, id::varchar id, event_type kind, (id%4)::varchar as "partition", event_id::varchar as "offset"
from (select 'u' op, case when event_id%3=0 then 0 else user_id end id, event_type, event_id from events)
qualify row_number() over (partition by id order by event_id desc) = 1"""


def cdc_catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: what the catalog sink stores."""
    flat = envelope.flatten(customer_log(spark, sf_dir), CUSTOMER)
    return envelope.for_sink(flat, "hive", CUSTOMER)


CDC_CATALOG_COLUMNS = f"""with {CUSTOMER_EVENTS},
flat as (select op, k::varchar id, name, nation::varchar nation, segment, {CUSTOMER_META} from customer_events)
select id, name, nation, segment, op, ts from flat"""


def cdc_jdbc_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: what the JDBC sink stores."""
    flat = envelope.flatten(order_log(spark, sf_dir), ORDER)
    return envelope.for_sink(flat, "jdbc", ORDER)


CDC_JDBC_COLUMNS = f"""with {ORDER_EVENTS}
select k::varchar id, customer::varchar customer, status, cents::varchar cents, epoch_ms(day)::varchar as day, op
from order_events"""


def cdc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics merged by column name."""
    return customer_log(spark, sf_dir).unionByName(order_log(spark, sf_dir))


def next_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.next_offsets(cdc_topics(spark, sf_dir))


BOTH_EVENTS = f"""{CUSTOMER_EVENTS}, {ORDER_EVENTS},
records as (select 'customer' topic, k, pos from customer_events
            union all select 'orders', k, pos from order_events)"""

NEXT_OFFSETS = f"""with {BOTH_EVENTS}
select topic, (k%4)::int as "partition", max(pos)+1 next_offset from records group by 1, 2"""


def starting_offsets_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.starting_offsets(next_offsets(spark, sf_dir))


STARTING_OFFSETS_JSON = f"""with {BOTH_EVENTS},
nexts as (select topic, (k%4)::int p, max(pos)+1 o from records group by 1, 2),
per_topic as (select topic, '{{' || string_agg('"' || p || '":' || o, ',' order by p) || '}}' m
              from nexts group by 1)
select '{{' || string_agg('"' || topic || '":' || m, ',' order by topic) || '}}' starting_offsets from per_topic"""


def topic_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.topic_totals(cdc_topics(spark, sf_dir))


TOPIC_TOTALS = f"""with {BOTH_EVENTS} select topic, count(*) n from records group by 1"""


def delete_by_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return changes.delete_where(rows, "o_orderstatus = 'F' and o_totalprice > 100000")


DELETE_BY_CONDITION = """
select o_orderkey, o_orderstatus, o_totalprice from orders
where not coalesce(o_orderstatus = 'F' and o_totalprice > 100000, false)"""

QUERIES = {
    "cdc_flatten": (cdc_flatten, CDC_FLATTEN),
    "cdc_create_only": (cdc_create_only, CDC_CREATE_ONLY),
    "cdc_quarantine": (cdc_quarantine, CDC_QUARANTINE),
    "cdc_accepted": (cdc_accepted, CDC_ACCEPTED),
    "cdc_typed": (cdc_typed, CDC_TYPED),
    "cdc_bad_types": (cdc_bad_types, CDC_BAD_TYPES),
    "cdc_current_state": (cdc_current_state, CDC_CURRENT_STATE),
    "cdc_last_change": (cdc_last_change, CDC_LAST_CHANGE),
    "cdc_hot_keys": (cdc_hot_keys, CDC_HOT_KEYS),
    "cdc_catalog_columns": (cdc_catalog_columns, CDC_CATALOG_COLUMNS),
    "cdc_jdbc_columns": (cdc_jdbc_columns, CDC_JDBC_COLUMNS),
    "next_offsets": (next_offsets, NEXT_OFFSETS),
    "starting_offsets_json": (starting_offsets_json, STARTING_OFFSETS_JSON),
    "topic_totals": (topic_totals, TOPIC_TOTALS),
    "delete_by_condition": (delete_by_condition, DELETE_BY_CONDITION),
}
