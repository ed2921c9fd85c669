"""The same operators on streams, run to completion, and the sinks.

Every query writes below a fresh work folder and gives what was written.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamsync.config import load
from streamsync.maintenance.compact import compact
from streamsync.operators import casting, changes, envelope, windows, words
from streamsync.plans import cdc, signals, text
from streamsync.plans.logs import CUSTOMER, PER_KEY, change_log, customer_log, table
from streamsync.scratch import file_system, work_dir
from streamsync.sinks import catalog, files, jdbc
from streamsync.sources import readers
from streamsync.streaming.batches import State
from streamsync.streaming.jobs import (
    finish,
    for_each_batch,
    run_jdbc_append,
    run_sync,
    run_telemetry,
    start,
)

# Bytes of a log in one micro-batch.
BOUNDED = {"maxBytesPerTrigger": str(128 * 1024 * 1024)}
# Steps in which the events reach a stream, in time order.
STEPS = 4


def stored_log(log: DataFrame, path: str, steps: int = 3) -> dict[str, object]:
    """Write a log to files in log order, the steps of a key one after the other.

    The log is made once and read again for each step; a file source reads older files
    first.  Gives the reading options for bounded micro-batches.
    """
    kept = log.withColumn("step", F.col("offset") % steps).persist()
    try:
        for step in range(steps):
            kept.where(F.col("step") == step).drop("step").write.mode("append").parquet(path)
    finally:
        kept.unpersist()
    return BOUNDED


def last_result(rows: DataFrame, mode: str, work: str) -> DataFrame:
    """Run an aggregating stream; in complete mode the last batch is the whole result,
    in update mode each batch holds the groups that changed."""
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{work}/out" if mode == "complete" else f"{work}/out/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    finish(for_each_batch(rows, write, f"{work}/checkpoint", mode))
    return spark.read.parquet(f"{work}/out")


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the step in which they arrive: quarters of their time, but every
    97th event arrives a step late."""
    events = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    quarter = F.floor((at - low) * STEPS / F.lit((high or 0) - (low or 0) + 1))
    late = F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    return events.withColumn("step", F.least(quarter + late, F.lit(STEPS - 1)).cast("int"))


ARRIVING = f"""
arriving as (
  select *, least(floor((epoch_us(ts) - low) * {STEPS}::double / (high - low + 1))::int
                  + case when event_id % 97 = 0 then 1 else 0 end, {STEPS - 1}) as step
  from events, (select min(epoch_us(ts)) low, max(epoch_us(ts)) high from events))"""


def in_steps(rows: DataFrame, work: str, mode: str, build) -> DataFrame:
    """Run an aggregating stream over rows that arrive step by step: each step is some more
    files in the folder it reads, and at least a micro-batch of its own."""
    spark, schema = rows.sparkSession, rows.drop("step").schema
    for step in range(STEPS):
        rows.where(F.col("step") == step).drop("step").write.mode("append").parquet(f"{work}/in")
        stream = readers.files(spark, f"{work}/in", schema, "parquet", **BOUNDED)
        result = last_result(build(stream), mode, work)
    return result


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files line by line, complete mode."""
    work = work_dir(spark, "words")
    text.documents(spark, sf_dir).withColumn("value", F.explode(F.split("value", "\n"))).write.text(f"{work}/in")
    lines = readers.text_lines(spark, f"{work}/in", lineSep="\n", **BOUNDED)
    return last_result(words.word_count(words.words(lines)), "complete", work)


STREAM_WORD_COUNT = """
select "value", count(*) as "count" from (select unnest(
  case when regexp_full_match(line, ' +') then []
       else string_split(regexp_replace(line, ' +$', ''), ' ') end) as "value"
  from (select unnest(string_split(text, chr(10))) line from documents)) group by 1"""


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 in update mode: the count of a window is that of the last batch it changed in."""
    work = work_dir(spark, "sliding")
    line = F.concat("event_type", F.lit(" "), "props")
    lines = arriving(spark, sf_dir).select(line.alias("value"), F.col("ts").alias("timestamp"), "step")

    def counted(stream: DataFrame) -> DataFrame:
        return windows.count_by_window(
            words.timed_words(stream), "timestamp", "word", "4 minutes", "2 minutes"
        )

    updates = in_steps(lines, work, "update", counted)
    return updates.groupBy("start", "end", "word").agg(F.max_by("n", "batch").alias("n"))


def stream_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the time of each line's file; every word is in two of them."""
    work = work_dir(spark, "ingest")
    text.event_lines(spark, sf_dir).select("value").write.text(f"{work}/in")
    lines = readers.text_lines(spark, f"{work}/in", timestamp=True)
    counted = windows.count_by_window(
        words.timed_words(lines), "timestamp", "word", "4 minutes", "2 minutes"
    )
    whole = last_result(counted, "complete", work)
    return whole.groupBy("word").agg(F.sum("n").alias("n"), F.count_if(F.col("end") <= F.col("start")).alias("empty"))


STREAM_INGEST_TIME = r"""
select word, (2*count(*))::bigint n, 0::bigint as "empty"
from (select unnest(regexp_split_to_array(
        regexp_replace(event_type || ' ' || props, '\W+$', ''), '\W+')) word from events) group by 1"""


def stream_sorted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines from files, complete mode, sorted in the stream."""
    work = work_dir(spark, "sorted")
    text.timed_lines(spark, sf_dir).write.text(f"{work}/in")
    good = words.stamped_words(readers.text_lines(spark, f"{work}/in")).where("reason is null")
    counted = windows.count_by_window(good, "ts", "word", "10 minutes", "5 minutes")
    return last_result(windows.sorted_windows(counted, "word"), "complete", work)


def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a watermark and append mode, windows the watermark has passed; rows that
    arrive after that of their window are left out."""
    work = work_dir(spark, "watermark")
    e = arriving(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "step")

    def counted(stream: DataFrame) -> DataFrame:
        return windows.count_by_window(stream, "ts", "event_type", "1 hour", watermark="2 hours")

    closed = in_steps(e, work, "append", counted)
    return closed.select(
        F.col("start").cast("timestamp_ntz").alias("start"),
        F.col("end").cast("timestamp_ntz").alias("end"),
        "event_type",
        "n",
    )


STREAM_WATERMARK = f"""with {ARRIVING},
marks as (
  select s.step, (select date_trunc('millisecond', max(ts)) - interval 2 hour from arriving a where a.step < s.step) mark
  from (select unnest(range({STEPS})) step) s),
kept as (
  select *, time_bucket(interval 1 hour, ts) as start, time_bucket(interval 1 hour, ts) + interval 1 hour as stop
  from arriving join marks using (step))
select start, stop as "end", event_type, count(*) n from kept
where (mark is null or stop > mark)
  and stop <= (select date_trunc('millisecond', max(ts)) - interval 2 hour from events)
group by all"""


def stream_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files with a declared schema."""
    work = work_dir(spark, "people")
    people = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), F.floor("value").alias("age"), F.lit("-").alias("sex")
    )
    people.write.json(f"{work}/in")
    stream = readers.files(spark, f"{work}/in", "name string, age bigint, sex string", "json")
    return last_result(words.adults_by_name(stream), "complete", work)


def bound_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order and width, bound to a schema."""
    wide = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), "c_custkey"
    )
    schema = T.StructType([
        T.StructField("name", T.StringType()), T.StructField("nation", T.LongType()),
    ])
    return readers.bind(wide, schema)


BOUND_BY_NAME = "select c_name as name, c_nationkey::bigint nation from customer"


def file_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the flat changes as a CSV, JSON, ORC and Parquet file stream each."""
    work = work_dir(spark, "files")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    running, out = [], []
    for fmt in files.FORMATS:
        log = readers.record_log(spark, f"{work}/log", **options)
        rows = envelope.for_sink(envelope.flatten(log, CUSTOMER), "file", CUSTOMER)
        running.append(start(files.file_stream(rows, f"{work}/{fmt}", f"{work}/{fmt}_checkpoint", fmt)))
        out.append((fmt, f"{work}/{fmt}", rows.schema))
    for query in running:
        query.awaitTermination()
    read = [spark.read.format(f).schema(s).load(p).withColumn("format", F.lit(f)) for f, p, s in out]
    result = read[0]
    for other in read[1:]:
        result = result.unionByName(other)
    return result


FILE_SINKS = f"""with {cdc.CUSTOMER_EVENTS}
select op, k::varchar id, name, nation::varchar nation, segment, {cdc.CUSTOMER_META}, "format"
from customer_events, unnest(['csv', 'json', 'orc', 'parquet']) t("format")"""


def table_for(name: str) -> str:
    return f"streamsync_{name}_{uuid.uuid4().hex[:12]}"


def contents(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The rows of a table, which is dropped from the catalog; its folder stays."""
    schema = readers.table(spark, name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def catalog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended twice, once to create the table."""
    work, name = work_dir(spark, "append"), table_for("append")
    rows = envelope.for_sink(envelope.flatten(customer_log(spark, sf_dir), CUSTOMER), "hive", CUSTOMER)
    for _ in range(2):
        catalog.append(rows, name, path=f"{work}/table")
    return contents(spark, name, f"{work}/table")


CATALOG_APPEND = f"""with {cdc.CUSTOMER_EVENTS}
select k::varchar id, name, nation::varchar nation, segment, op,
  strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts
from customer_events, range(2)"""


def catalog_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 by batch: two batches, the first one repeated, each row there once."""
    work, name = work_dir(spark, "batches"), table_for("batches")
    rows = envelope.flatten(customer_log(spark, sf_dir), CUSTOMER)
    for batch_id in (0, 1, 0):
        part = rows.where(F.col("partition").cast("int") % 2 == batch_id)
        catalog.write_batch(part, name, batch_id, path=f"{work}/table")
    return contents(spark, name, f"{work}/table")


CATALOG_BATCHES = f"""with {cdc.CUSTOMER_EVENTS}
select op, k::varchar id, name, nation::varchar nation, segment, {cdc.CUSTOMER_META}, (k%2)::bigint batch_id
from customer_events"""


def config_file(spark: SparkSession, work: str, write_type: str, **sections: dict) -> str:
    """A job configuration stored as a JSON file, as a user would write it."""
    document = {
        "syncSpark": {
            "sparkAppName": "customers", "interval": 10, "writeType": write_type, "requiredKey": "id",
        },
        "syncColumns": [
            {"colIndex": 2, "typeName": "string", "colName": "name"},
            {"colIndex": 1, "typeName": "number", "colName": "id"},
            {"colIndex": 3, "typeName": "number", "colName": "nation"},
            {"colIndex": 4, "typeName": "string", "colName": "segment"},
        ],
        "syncState": {"path": f"{work}/state"},
        "syncJdbc": {"pk": "id"},
        **sections,
    }
    path = f"{work}/config"
    spark.createDataFrame([(json.dumps(document),)], "value string").write.mode("overwrite").text(path)
    fs, place = file_system(spark, path)
    return fs.makeQualified(place).toString()


def sync(spark: SparkSession, work: str, write_type: str, options: dict, **sections: dict) -> None:
    """Load a configuration and run its job over the log that is there."""
    source = {"path": f"{work}/log", "format": "parquet", "options": options}
    config = load(spark, "hdfs", config_file(spark, work, write_type, syncSource=source, **sections))
    run_sync(spark, config, once=True).awaitTermination()


def hive_section(work: str, name: str, checkpoint: str = "checkpoint") -> dict[str, str]:
    return {
        "hiveTableName": name, "format": "parquet", "writePath": f"{work}/table",
        "checkpointLocation": f"{work}/{checkpoint}",
    }


def sync_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into a catalog table."""
    work, name = work_dir(spark, "sync"), table_for("sync")
    options = stored_log(cdc.damaged_log(spark, sf_dir), f"{work}/log")
    sync(spark, work, "hive", options, syncFile=hive_section(work, name))
    return contents(spark, name, f"{work}/table")


SYNC_CATALOG = f"""with {cdc.CUSTOMER_EVENTS}
select k::varchar id, name, nation::varchar nation, segment, op,
  strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts
from customer_events where pos%17<>0 and pos%7<>0 and pos%11<>0 and op<>'d'"""


def sync_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into files."""
    work = work_dir(spark, "sync")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    section = {
        "format": "json", "writeMode": "append", "writePath": f"{work}/out",
        "partitionBy": "op", "checkpointLocation": f"{work}/checkpoint",
    }
    sync(spark, work, "file", options, syncFile=section)
    schema = envelope.flatten(customer_log(spark, sf_dir), CUSTOMER).schema
    return spark.read.schema(schema).json(f"{work}/out")


def sync_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and record counts the job has recorded."""
    work, name = work_dir(spark, "sync"), table_for("positions")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    sync(spark, work, "hive", options, syncFile=hive_section(work, name))
    spark.sql(f"DROP TABLE {name}")
    state = State(f"{work}/state", "customers")
    state.condense(spark)
    recorded = state.recorded(spark)
    return recorded.groupBy("app", "topic", "partition").agg(
        F.max("next_offset").alias("next_offset"), F.sum("n").alias("n")
    )


SYNC_POSITIONS = f"""with {cdc.CUSTOMER_EVENTS}
select 'customers' app, 'customer' topic, (k%4)::int as "partition", max(pos)+1 next_offset, count(*)::bigint n
from customer_events group by all"""


def sync_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job has set aside."""
    work, name = work_dir(spark, "sync"), table_for("quarantine")
    options = stored_log(cdc.damaged_log(spark, sf_dir), f"{work}/log")
    sync(spark, work, "hive", options, syncFile=hive_section(work, name))
    spark.sql(f"DROP TABLE {name}")
    rows = State(f"{work}/state", "customers").quarantined(spark)
    return rows.select("value", "topic", "partition", "offset", "reason")


def sync_file_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job that writes files has set aside."""
    work = work_dir(spark, "sync")
    options = stored_log(cdc.damaged_log(spark, sf_dir), f"{work}/log")
    section = {"format": "json", "writePath": f"{work}/out", "checkpointLocation": f"{work}/checkpoint"}
    sync(spark, work, "file", options, syncFile=section)
    rows = State(f"{work}/state", "customers").quarantined(spark)
    return rows.select("value", "topic", "partition", "offset", "reason")


def sync_create_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that takes creates only, with their time."""
    work, name = work_dir(spark, "sync"), table_for("create")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    job = {"sparkAppName": "customers", "interval": 10, "writeType": "hive", "ops": ["c"], "recordColumns": ["ts"]}
    sync(spark, work, "hive", options, syncSpark=job, syncFile=hive_section(work, name))
    return contents(spark, name, f"{work}/table")


SYNC_CREATE_ONLY = f"""with {cdc.CUSTOMER_EVENTS}
select k::varchar id, name, nation::varchar nation, segment, op,
  strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts
from customer_events where op = 'c'"""


def cdc_reserved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns called ``value`` and ``reason``, through a file and a catalog job."""
    work, name = work_dir(spark, "sync"), table_for("names")
    columns = {"id": F.col("c_custkey"), "value": F.col("c_nationkey"), "reason": F.col("c_mktsegment")}
    log = change_log(table(spark, sf_dir, "customer"), "c_custkey", columns, "value", "customer")
    options = stored_log(log, f"{work}/log")
    named = [{"colIndex": i, "typeName": "string", "colName": c} for i, c in enumerate(columns)]
    section = {"format": "parquet", "writePath": f"{work}/out", "checkpointLocation": f"{work}/file"}
    sync(spark, work, "file", options, syncColumns=named, syncFile=section, syncState={})
    sync(spark, work, "hive", options, syncColumns=named, syncFile=hive_section(work, name), syncState={})
    files_ = spark.read.parquet(f"{work}/out").select("id", "value", "reason", "op", F.lit("file").alias("sink"))
    rows = contents(spark, name, f"{work}/table")
    return files_.union(rows.select("id", "value", "reason", "op", F.lit("hive")))


CDC_RESERVED_NAMES = f"""with {cdc.CUSTOMER_EVENTS}
select k::varchar id, nation::varchar as "value", segment as reason, op, sink
from customer_events, (select unnest(['file', 'hive']) sink)"""


def sync_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later runs without the first one's checkpoint go on at the recorded positions."""
    work, name = work_dir(spark, "sync"), table_for("resume")
    log = customer_log(spark, sf_dir)
    half = log.where(F.col("offset") % 3 == 0).agg(F.max("offset") / 2).first()[0]
    log.where(F.col("offset") < half).write.parquet(f"{work}/log")
    sync(spark, work, "hive", BOUNDED, syncFile=hive_section(work, name))
    log.where(F.col("offset") >= half).write.mode("append").parquet(f"{work}/log")
    sync(spark, work, "hive", BOUNDED, syncFile=hive_section(work, name, "second_checkpoint"))
    return contents(spark, name, f"{work}/table")


def sync_resume_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batch after a resume fails once, and the restart still takes each record
    once."""
    work, name = work_dir(spark, "sync"), table_for("crash")
    log = customer_log(spark, sf_dir)
    half = log.where(F.col("offset") % 3 == 0).agg(F.max("offset") / 2).first()[0]
    log.where(F.col("offset") < half).write.parquet(f"{work}/log")
    sync(spark, work, "hive", BOUNDED, syncFile=hive_section(work, name))
    log.where(F.col("offset") >= half).write.mode("append").parquet(f"{work}/log")
    # the batch fails after the resume has begun
    broken = {**hive_section(work, name, "second_checkpoint"), "tableProvider": "no_such_format"}
    try:
        sync(spark, work, "hive", BOUNDED, syncFile=broken)
    except Exception as error:
        if "no_such_format" not in str(error).lower() and "provider" not in str(error).lower():
            raise
    else:
        raise RuntimeError("the broken run came to its end")
    sync(spark, work, "hive", BOUNDED, syncFile=hive_section(work, name, "second_checkpoint"))
    return contents(spark, name, f"{work}/table")


SYNC_ALL = f"""with {cdc.CUSTOMER_EVENTS}
select k::varchar id, name, nation::varchar nation, segment, op,
  strftime(timestamp '2024-01-01' + to_seconds(pos), '%Y-%m-%d %H:%M:%S') as ts
from customer_events"""


def telemetry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry job into a catalog table."""
    work, name = work_dir(spark, "telemetry"), table_for("signals")
    options = stored_log(signals.signal_log(spark, sf_dir), f"{work}/log")
    log = readers.record_log(spark, f"{work}/log", **options)
    state = State(f"{work}/state", "signals")
    run_telemetry(log, name, f"{work}/checkpoint", state, path=f"{work}/table", interval=None).awaitTermination()
    return contents(spark, name, f"{work}/table").select(*signals.FIXED)


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the line items in many small files, compacted twice."""
    work = work_dir(spark, "compact")
    lines = table(spark, sf_dir, "lineitem")
    small = max(1000, lines.count() // 64)
    lines.write.option("maxRecordsPerFile", small).parquet(f"{work}/table")
    for _ in range(2):
        compact(spark, f"{work}/table", target_mib=256)
    return spark.read.parquet(f"{work}/table")


def compact_grown_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: files of which the later ones have one more column."""
    work = work_dir(spark, "compact")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    odd = F.col("l_orderkey") % 2 == 1
    lines.where(~odd).drop("l_tax").write.parquet(f"{work}/table")
    lines.where(odd).write.mode("append").parquet(f"{work}/table")
    compact(spark, f"{work}/table", target_mib=256)
    return spark.read.parquet(f"{work}/table")


COMPACT_GROWN_SCHEMA = """
select l_orderkey, l_linenumber, l_quantity, case when l_orderkey % 2 = 1 then l_tax end l_tax from lineitem"""


def compact_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: partition values with leading zeros, and none, stay as they are."""
    work = work_dir(spark, "compact")
    zeros = F.lpad(F.col("l_linenumber").cast("string"), 3, "0")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", F.when(F.col("l_linenumber") < 7, zeros).alias("line")
    )
    lines.write.partitionBy("line").parquet(f"{work}/table")
    compact(spark, f"{work}/table", target_mib=256, partition_by=["line"])
    schema = "l_orderkey bigint, l_quantity double, line string"
    return spark.read.schema(schema).parquet(f"{work}/table")


COMPACT_TEXT_PARTITIONS = """
select l_orderkey, l_quantity, case when l_linenumber < 7 then lpad(l_linenumber::varchar, 3, '0') end line
from lineitem"""


def derby(spark: SparkSession, name: str) -> jdbc.JdbcTarget:
    """A table in an embedded database of this process; only a local session sees it."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    return jdbc.JdbcTarget(url, name, options={"numPartitions": "4", "batchsize": "5000"})


def jdbc_section(target: jdbc.JdbcTarget, save_mode: str) -> dict[str, object]:
    return {
        "dbType": "DERBY", "pk": "id", "saveMode": save_mode, "jdbcUrl": target.url,
        "table": target.table, "options": dict(target.options),
    }


def read_in_ranges(
    spark: SparkSession,
    sf_dir: str,
    target: jdbc.JdbcTarget,
    column: str,
    factor: int = 1,
    condition: str | None = None,
) -> DataFrame:
    """S8 in parallel ranges of a column that goes up to the customer keys times a factor."""
    low, high = table(spark, sf_dir, "customer").agg(F.min("c_custkey"), F.max("c_custkey")).first()
    return jdbc.read(spark, target, condition, column, (low * factor, (high + 1) * factor), 4)


def sync_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job into a JDBC table, batch after batch."""
    work, target = work_dir(spark, "sync"), derby(spark, "customers")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    sync(
        spark, work, "jdbc", options,
        syncFile={"checkpointLocation": f"{work}/checkpoint"}, syncJdbc=jdbc_section(target, "upsert"),
    )
    return read_in_ranges(spark, sf_dir, target, "id")


SYNC_JDBC = """
select c_custkey id, c_name as name,
  (case when c_custkey%3=0 then c_nationkey+100 else c_nationkey end)::bigint nation, c_mktsegment segment
from customer where c_custkey%5<>0"""


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 applied twice, K12, then S8 in parallel ranges with a pushed filter."""
    target = derby(spark, "customers")
    flat = envelope.flatten(customer_log(spark, sf_dir), CUSTOMER)
    types = {"id": "number", "name": "string", "nation": "number", "segment": "string"}
    for _ in range(2):
        jdbc.sync(flat, target, "id", types)
    nation = jdbc.quoted(spark, target, "nation")
    jdbc.delete_where(spark, target, f"{nation} = 7")
    return read_in_ranges(spark, sf_dir, target, "id", condition="nation > 3")


JDBC_ROUNDTRIP = f"select * from ({SYNC_JDBC}) where nation <> 7 and nation > 3"


def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: all flat columns appended batch by batch, each batch once."""
    work, target = work_dir(spark, "jdbc"), derby(spark, "changes")
    options = stored_log(customer_log(spark, sf_dir), f"{work}/log")
    flat = envelope.flatten(readers.record_log(spark, f"{work}/log", **options), CUSTOMER)
    rows = flat.withColumn("offset", F.col("offset").cast("bigint"))
    run_jdbc_append(rows, target, "changes", f"{work}/checkpoint", interval=None).awaitTermination()
    written = read_in_ranges(spark, sf_dir, target, "offset", PER_KEY)
    return written.withColumn("offset", F.col("offset").cast("string"))


QUERIES = {
    "stream_word_count": (stream_word_count, STREAM_WORD_COUNT),
    "stream_sliding": (stream_sliding, text.SLIDING_4_2),
    "stream_ingest_time": (stream_ingest_time, STREAM_INGEST_TIME),
    "stream_sorted_windows": (stream_sorted_windows, text.SLIDING_10_5_SORTED),
    "stream_watermark": (stream_watermark, STREAM_WATERMARK),
    "stream_filter_count": (stream_filter_count, text.FILTER_GROUP_COUNT),
    "bound_by_name": (bound_by_name, BOUND_BY_NAME),
    "file_sinks": (file_sinks, FILE_SINKS),
    "catalog_append": (catalog_append, CATALOG_APPEND),
    "catalog_batches": (catalog_batches, CATALOG_BATCHES),
    "sync_catalog": (sync_catalog, SYNC_CATALOG),
    "sync_file": (sync_file, cdc.CDC_FLATTEN),
    "sync_positions": (sync_positions, SYNC_POSITIONS),
    "sync_quarantine": (sync_quarantine, cdc.CDC_QUARANTINE),
    "sync_file_quarantine": (sync_file_quarantine, cdc.CDC_QUARANTINE),
    "sync_create_only": (sync_create_only, SYNC_CREATE_ONLY),
    "cdc_reserved_names": (cdc_reserved_names, CDC_RESERVED_NAMES),
    "sync_resume": (sync_resume, SYNC_ALL),
    "sync_resume_crash": (sync_resume_crash, SYNC_ALL),
    "telemetry_stream": (telemetry_stream, signals.TELEMETRY_PARSE),
    "compact_table": (compact_table, "select * from lineitem"),
    "compact_grown_schema": (compact_grown_schema, COMPACT_GROWN_SCHEMA),
    "compact_text_partitions": (compact_text_partitions, COMPACT_TEXT_PARTITIONS),
    "sync_jdbc": (sync_jdbc, SYNC_JDBC),
    "jdbc_roundtrip": (jdbc_roundtrip, JDBC_ROUNDTRIP),
    "jdbc_append": (jdbc_append, cdc.CDC_FLATTEN),
}
