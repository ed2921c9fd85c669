import json
import os

import pytest
from pyspark.sql import functions as F

from streamsync.config import parse
from streamsync.maintenance.compact import coalesce_count, compact, compact_table, packed, partition_count
from streamsync.operators import changes, envelope, offsets, words
from streamsync.sinks import catalog, files, jdbc
from streamsync.sources import readers
from streamsync.streaming.batches import State, batch_writer
from streamsync.streaming.jobs import finish, for_each_batch, run_jdbc_append, run_sync, start

COLUMNS = ["id", "name"]


def event(op, key, name):
    image = {"id": key, "name": name}
    payload = {"op": op, "before": image if op == "d" else None, "after": None if op == "d" else image}
    return json.dumps({"payload": payload})


def put(spark, path, events, first=0):
    """Append events as one file of a record log."""
    rows = [(t, "t", 0, first + i) for i, t in enumerate(events)]
    spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint").withColumn(
        "timestamp", F.timestamp_seconds(F.col("offset"))
    ).coalesce(1).write.mode("append").parquet(path)


EVENTS = [
    [event("c", 1, "a"), event("c", 2, "b"), event("c", 3, "c")],
    [event("u", 1, "a2"), event("d", 2, "b"), event("c", 4, "d"), event("d", 4, "d"), "junk"],
    [event("c", 2, "again"), event("d", 3, "c"), event("d", 3, "c"), None],
]
FINAL = {(1, "a2"), (2, "again")}


def fill(spark, path):
    first = 0
    for part in EVENTS:
        put(spark, path, part, first)
        first += len(part)


def target(spark, name="t"):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return jdbc.JdbcTarget(f"jdbc:derby:memory:{os.urandom(6).hex()};create=true", name)


def config(tmp_path, write_type, to=None, checkpoint="checkpoint", raw=None, **more):
    return parse(json.dumps({
        "syncSpark": {"sparkAppName": "app", "interval": 1, "writeType": write_type},
        "syncColumns": [
            {"colIndex": 1, "typeName": "number", "colName": "id"},
            {"colIndex": 2, "typeName": "string", "colName": "name"},
        ],
        "syncFile": {
            "checkpointLocation": f"{tmp_path}/{checkpoint}", "format": "parquet", "writePath": f"{tmp_path}/out", **more,
        },
        "syncSource": {"path": f"{tmp_path}/log", "options": {"maxFilesPerTrigger": 1}},
        "syncState": {"path": f"{tmp_path}/state"},
        "syncJdbc": {"pk": "id", "saveMode": "upsert", "jdbcUrl": to.url if to else "", "table": to.table if to else ""},
        **(raw or {}),
    }))


def test_upsert_job_and_its_records(spark, tmp_path):
    fill(spark, f"{tmp_path}/log")
    to = target(spark)
    run_sync(spark, config(tmp_path, "jdbc", to), once=True).awaitTermination()
    assert {tuple(r) for r in jdbc.read(spark, to).collect()} == FINAL
    state = State(f"{tmp_path}/state", "app")
    recorded = state.recorded(spark)
    assert recorded.count() == 3 and recorded.where("query_id = 'query'").count() == 0
    assert [tuple(r) for r in state.positions(spark).collect()] == [("t", 0, 12)]
    assert offsets.running_totals(recorded).first().total == 12
    assert [(r.value, r.reason) for r in state.quarantined(spark).collect()] == [("junk", "unreadable")]
    state.condense(spark)
    assert state.recorded(spark).count() == 3 and state.quarantined(spark).count() == 1
    assert not jdbc.table_exists(spark, to.sibling("_staging"))


def test_restart_from_the_checkpoint(spark, tmp_path):
    to = target(spark)
    first = 0
    for part in EVENTS:
        put(spark, f"{tmp_path}/log", part, first)
        first += len(part)
        run_sync(spark, config(tmp_path, "jdbc", to), once=True).awaitTermination()
    assert {tuple(r) for r in jdbc.read(spark, to).collect()} == FINAL


def test_a_failed_batch_is_repeated(spark, tmp_path):
    fill(spark, f"{tmp_path}/log")
    seen, fail = [], [False, True]

    def write(rows, batch_id):
        if batch_id == 1 and fail.pop():
            raise RuntimeError("lost")
        seen.extend((batch_id, r.op, r.id) for r in rows.collect())

    decode = lambda batch: envelope.decode(batch, COLUMNS, key="id")
    state = State(f"{tmp_path}/state", "app")
    handle = batch_writer(decode, envelope.accepted, envelope.quarantined, write, state)

    def run():
        log = readers.record_log(spark, f"{tmp_path}/log", maxFilesPerTrigger=1)
        finish(for_each_batch(log, handle, f"{tmp_path}/checkpoint"))

    with pytest.raises(Exception):
        run()
    assert state.positions(spark).first().next_offset == 3
    run()
    assert sorted(seen) == sorted([
        (0, "c", "1"), (0, "c", "2"), (0, "c", "3"), (1, "u", "1"), (1, "d", "2"), (1, "c", "4"),
        (1, "d", "4"), (2, "c", "2"), (2, "d", "3"), (2, "d", "3"),
    ])
    assert state.positions(spark).first().next_offset == 12


def test_upserts_in_any_split_and_repeated(spark, tmp_path):
    to = target(spark)
    put(spark, f"{tmp_path}/log", sum(EVENTS, []))
    flat = envelope.flatten(readers.record_log(spark, f"{tmp_path}/log", streaming=False), COLUMNS)
    types = {"id": "number", "name": "string"}
    for _ in range(2):
        jdbc.sync(flat, to, "id", types)
        assert {tuple(r) for r in jdbc.read(spark, to).collect()} == FINAL
    assert jdbc.read(spark, to).schema["id"].dataType.simpleString() == "bigint"
    assert {tuple(r) for r in jdbc.read(spark, to, "id > 1").collect()} == {(2, "again")}
    plan = jdbc.read(spark, to, "id > 1")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,1)" in plan


def test_text_keys_and_typed_columns(spark):
    to = target(spark)
    rows = [("c", "k'1", "5", "0", "0", "1"), ("c", "k2", None, "1571639105009", "0", "2")]
    df = spark.createDataFrame(rows, "op string, k string, n string, d string, partition string, offset string")
    jdbc.sync(df, to, "k", {"k": "string", "n": "number", "d": "date"})
    got = {(r.k, r.n, str(r.d)) for r in jdbc.read(spark, to).collect()}
    assert got == {("k'1", 5, "1970-01-01 00:00:00"), ("k2", None, "2019-10-21 06:25:05.009000")}
    gone = spark.createDataFrame([("d", "k'1", None, None, "0", "3")], df.schema)
    jdbc.sync(gone, to, "k", {"k": "string", "n": "number", "d": "date"})
    assert [r.k for r in jdbc.read(spark, to).collect()] == ["k2"]


def test_table_checks(spark):
    to = target(spark)
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert jdbc.create_table(spark, to, df.schema, "id") and not jdbc.create_table(spark, to, df.schema, "id")
    jdbc.verify_columns(spark, to, ["id", "name"])
    with pytest.raises(ValueError, match="2 table columns, 1 row columns"):
        jdbc.verify_columns(spark, to, ["id"])
    with pytest.raises(ValueError, match="'name', row column 'nom'"):
        jdbc.verify_columns(spark, to, ["id", "nom"])
    jdbc.overwrite(df, to)
    assert jdbc.delete_where(spark, to, '"id" = 1') == 1
    assert jdbc.drop_table(spark, to) and not jdbc.drop_table(spark, to)


def test_a_failing_statement_undoes_the_transaction(spark):
    to = target(spark)
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    jdbc.create_table(spark, to, df.schema, "id")
    jdbc.upsert(df, to, "id")
    name = jdbc.table_name(spark, to)
    with pytest.raises(Exception):
        jdbc.run(spark, to, [f"DELETE FROM {name}", "DELETE FROM nowhere"])
    assert jdbc.read(spark, to).count() == 1


def test_staging_starts_afresh_when_a_copy_is_refused(spark, monkeypatch):
    to = target(spark)
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, name string")
    tries = []
    real = jdbc.drop_table
    monkeypatch.setattr(jdbc, "drop_table", lambda s, t: tries.append(t.table) or real(s, t))
    with pytest.raises(Exception):
        jdbc.stage(df, to, "id")
    assert len(set(tries)) == jdbc.STAGING_ATTEMPTS
    assert all(t.startswith("t_staging_") for t in tries)


def test_staging_does_not_repeat_other_errors(spark, monkeypatch):
    to = target(spark)
    broken = F.udf(lambda x: 1 // 0, "bigint")
    df = spark.range(1).select(broken("id").alias("id"), F.lit("a").alias("name"))
    tries = []
    real = jdbc.create_table
    monkeypatch.setattr(jdbc, "create_table", lambda s, t, *a: tries.append(t.table) or real(s, t, *a))
    with pytest.raises(Exception):
        jdbc.stage(df, to, "id")
    assert len(tries) == 1


@pytest.mark.parametrize(
    "kind, keys",
    [
        ("decimal(20,2)", ["1.25", "1.75"]),
        ("date", ["0", "86400000"]),
        ("string", ["k" * 400, "k" * 400 + "x"]),
    ],
)
def test_keys_have_the_type_of_their_column(spark, kind, keys):
    to = jdbc.JdbcTarget(target(spark).url, "t", key_length=500)
    rows = [("c", k, str(i), "0", str(i)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "op string, k string, n string, partition string, offset string")
    for _ in range(2):
        jdbc.sync(df, to, "k", {"k": kind, "n": "number"})
    assert sorted(r.n for r in jdbc.read(spark, to).collect()) == [0, 1]


def test_append_counts_a_batch_once(spark):
    to = target(spark)
    df = spark.createDataFrame([("a", "c"), ("a", "c")], "name string, op string")
    assert jdbc.append_batch(df, to, "app", 0)
    assert not jdbc.append_batch(df, to, "app", 0)
    assert jdbc.append_batch(df, to, "app", 1) and jdbc.append_batch(df, to, "other", 0)
    assert jdbc.append_batch(df, to, "app", 0, "another query")
    assert not jdbc.append_batch(df, to, "app", 0, "another query")
    assert jdbc.read(spark, to).count() == 8


def test_append_with_two_checkpoints(spark, tmp_path):
    """A new checkpoint counts its batches from 0 again; their rows are not taken for old ones."""
    to, first = target(spark), 0
    for i, part in enumerate(EVENTS):
        put(spark, f"{tmp_path}/log", part, first)
        first += len(part)
        job = json.loads(json.dumps({"syncJdbc": {"saveMode": "append", "jdbcUrl": to.url, "table": to.table}}))
        document = config(tmp_path, "jdbc", to, checkpoint=f"c{i}", raw=job)
        run_sync(spark, document, once=True).awaitTermination()
    assert jdbc.read(spark, to).count() == 10


def test_jdbc_modes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("x y x\n")
    for mode in ("complete", "update"):
        to = target(spark, mode)
        counts = words.word_count(words.words(readers.text_lines(spark, f"{tmp_path}/in")))
        run_jdbc_append(counts, to, "app", f"{tmp_path}/{mode}", mode, "value", interval=None).awaitTermination()
        assert {tuple(r) for r in jdbc.read(spark, to).collect()} == {("x", 2), ("y", 1)}
    (tmp_path / "in" / "b").write_text("y z\n")
    for mode in ("update",):
        counts = words.word_count(words.words(readers.text_lines(spark, f"{tmp_path}/in")))
        run_jdbc_append(counts, to, "app", f"{tmp_path}/{mode}", mode, "value", interval=None).awaitTermination()
        assert {tuple(r) for r in jdbc.read(spark, to).collect()} == {("x", 2), ("y", 2), ("z", 1)}


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_a_file_stream_equals_the_batch(spark, tmp_path, fmt):
    fill(spark, f"{tmp_path}/log")
    log = readers.record_log(spark, f"{tmp_path}/log", maxFilesPerTrigger=1)
    rows = envelope.flatten(log, COLUMNS)
    finish(files.file_stream(rows, f"{tmp_path}/out", f"{tmp_path}/checkpoint", fmt, output_files=1))
    batch = envelope.flatten(readers.record_log(spark, f"{tmp_path}/log", streaming=False), COLUMNS)
    written = spark.read.format(fmt).schema(rows.schema).load(f"{tmp_path}/out")
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, batch.collect()))
    with pytest.raises(ValueError):
        files.file_stream(rows, "x", "y", fmt, mode="complete")


def test_console_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("x\n")
    finish(files.console_stream(readers.text_lines(spark, f"{tmp_path}/in"), f"{tmp_path}/c"))


BARE = {
    "syncSpark": {"sparkAppName": "app", "interval": 1, "writeType": "file"},
    "syncColumns": [{"colIndex": 1, "typeName": "number", "colName": "id"}],
    "syncSource": {"path": "x"},
}


def test_a_stream_needs_a_checkpoint(spark):
    rows = readers.rate(spark)
    for build in (
        lambda: for_each_batch(rows, print, ""),
        lambda: files.file_stream(rows, "x", ""),
        lambda: files.console_stream(rows, ""),
        lambda: run_sync(spark, parse(json.dumps({**BARE, "syncFile": {"writePath": "x"}}))),
    ):
        with pytest.raises(ValueError, match="checkpoint"):
            build()


def test_timed_trigger(spark, tmp_path):
    rows = readers.rate(spark, rows_per_second=50)
    query = start(files.file_stream(rows, f"{tmp_path}/out", f"{tmp_path}/c"), interval=1)
    try:
        for _ in range(30):
            query.awaitTermination(1)
            if query.lastProgress and query.lastProgress["numInputRows"] > 0:
                break
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_catalog_batches_of_two_queries(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    for query in ("one", "two", "one"):
        catalog.write_batch(df, "queries_t", 0, path=f"{tmp_path}/t", query_id=query)
    assert spark.table("queries_t").count() == 2


def test_an_exactly_once_catalog_job(spark, tmp_path):
    first = 0
    for i, part in enumerate(EVENTS):
        put(spark, f"{tmp_path}/log", part, first)
        first += len(part)
        section = {"hiveTableName": "once_t", "exactlyOnce": True}
        run_sync(spark, config(tmp_path, "hive", checkpoint=f"c{i}", **section), once=True).awaitTermination()
    assert spark.table("once_t").count() == 10 and spark.table("once_t").select("query_id").distinct().count() == 3


def test_a_log_of_several_files_has_several_bounded_batches(spark, tmp_path):
    fill(spark, f"{tmp_path}/log")
    source = {"path": f"{tmp_path}/log", "options": {"maxBytesPerTrigger": "1"}}
    document = config(tmp_path, "hive", raw={"syncSource": source}, hiveTableName="bounded_t")
    run_sync(spark, document, once=True).awaitTermination()
    recorded = State(f"{tmp_path}/state", "app").recorded(spark)
    assert recorded.select("batch_id").distinct().count() == 3 and spark.table("bounded_t").count() == 10


def test_streams_over_a_table_of_several_files(spark, tmp_path):
    from streamsync.plans import streams

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for query in (streams.stream_sliding, streams.stream_watermark):
        assert sorted(map(tuple, query(spark, str(tmp_path)).collect())) == sorted(map(tuple, query(spark, sf).collect()))


def test_catalog_batch_is_replaced_when_repeated(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    for batch_id in (0, 1, 1, 0):
        catalog.write_batch(df, "batches_t", batch_id, path=f"{tmp_path}/t")
    assert spark.table("batches_t").count() == 2


def small_files(spark, path, n=3000):
    spark.range(n).withColumn("k", F.col("id") % 3).write.option("maxRecordsPerFile", 100).parquet(path)


def parquet_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_compaction_twice(spark, tmp_path):
    path = f"{tmp_path}/t"
    small_files(spark, path)
    assert len(parquet_files(path)) >= 30
    for _ in range(2):
        assert compact(spark, path) == 1
        assert len(parquet_files(path)) == 1
        assert spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first() == (3000, 3000 * 2999 // 2)
    assert os.listdir(tmp_path) == ["t"]


def test_compaction_rewrites_whatever_the_number_of_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(10).coalesce(1).write.parquet(path)
    before = parquet_files(path)
    assert compact(spark, path) == 1
    assert parquet_files(path) != before and spark.read.parquet(path).count() == 10
    assert compact(spark, path, 1, pattern=f"{path}/*") == 1


def test_compaction_deals_pieces_of_files_without_a_shuffle(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(64_000).repartition(16).write.parquet(path)
    rows = spark.read.parquet(path)
    assert rows.rdd.getNumPartitions() >= 2
    few = packed(rows, 2)
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    few.write.parquet(f"{tmp_path}/few")
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/few").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 2 and max(sizes) <= 48_000 and sum(sizes) == 64_000
    assert packed(spark.read.parquet(f"{tmp_path}/few"), 40).rdd.getNumPartitions() == 40


def crashed(tmp_path, path):
    """A folder as a compaction that died between its two renames leaves it."""
    os.rename(path, f"{path}_old_abc")
    (tmp_path / ".t.compaction").write_text(json.dumps({"run": "abc"}))


def test_compaction_after_a_crash_between_the_renames(spark, tmp_path):
    path = f"{tmp_path}/t"
    small_files(spark, path)
    crashed(tmp_path, path)
    compact(spark, path)
    assert spark.read.parquet(path).count() == 3000
    assert os.listdir(tmp_path) == ["t"]


def test_recovery_touches_only_what_its_marker_names(spark, tmp_path):
    path, other = f"{tmp_path}/t", f"{tmp_path}/t_old_2023"
    spark.range(7).write.parquet(other)
    small_files(spark, path)
    compact(spark, path)
    crashed(tmp_path, path)
    compact(spark, path)
    assert spark.read.parquet(path).count() == 3000 and spark.read.parquet(other).count() == 7
    os.rename(path, f"{path}_old_gone")  # no marker: nothing is put back
    with pytest.raises(Exception):
        compact(spark, path)
    assert sorted(os.listdir(tmp_path)) == ["t_old_2023", "t_old_gone"]
    (tmp_path / ".t_old_gone.compaction").write_text("")  # died while it wrote the marker
    compact(spark, f"{path}_old_gone")
    assert spark.read.parquet(f"{path}_old_gone").count() == 3000


def test_compaction_of_a_partitioned_folder_needs_its_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    small_files(spark, path)
    spark.read.parquet(path).write.partitionBy("k").parquet(f"{tmp_path}/p")
    with pytest.raises(ValueError, match="partitioned by"):
        compact(spark, f"{tmp_path}/p")
    with pytest.raises(ValueError, match="partitioned by"):
        compact(spark, path, partition_by=["k"])


def test_compaction_leaves_a_changing_folder_alone(spark, tmp_path, monkeypatch):
    import streamsync.maintenance.compact as module

    path = f"{tmp_path}/t"
    small_files(spark, path)
    states = iter([(40, 1), (41, 2)])
    monkeypatch.setattr(module, "_state", lambda *_: next(states))
    with pytest.raises(RuntimeError, match="changed"):
        compact(spark, path)
    assert os.listdir(tmp_path) == ["t"] and spark.read.parquet(path).count() == 3000


def test_compaction_of_a_stream_folder(spark, tmp_path):
    fill(spark, f"{tmp_path}/log")
    log = readers.record_log(spark, f"{tmp_path}/log", maxFilesPerTrigger=1)
    finish(files.file_stream(envelope.flatten(log, COLUMNS), f"{tmp_path}/out", f"{tmp_path}/c"))
    with pytest.raises(RuntimeError, match="file stream"):
        compact(spark, f"{tmp_path}/out")
    compact(spark, f"{tmp_path}/out", stream_stopped=True)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10


def test_compaction_of_a_partitioned_table(spark, tmp_path):
    spark.range(3000).withColumn("k", F.col("id") % 3).write.partitionBy("k").option(
        "maxRecordsPerFile", 100
    ).option("path", f"{tmp_path}/t").saveAsTable("parted_t")
    out = compact_table(spark, "parted_t")
    assert out.groupBy("k").count().where("count = 1000").count() == 3
    assert len(parquet_files(f"{tmp_path}/t")) == 3


def test_file_counts(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * (3 * 1024 * 1024))
    (tmp_path / "b").write_bytes(b"x" * (2 * 1024 * 1024 + 7))
    assert partition_count(spark, str(tmp_path)) == 1
    assert partition_count(spark, str(tmp_path), 2) == 2
    assert coalesce_count(spark, f"{tmp_path}/*", 2) == 3
    assert coalesce_count(spark, f"{tmp_path}/none*", 2) == 1


def test_resume_without_the_checkpoint(spark, tmp_path):
    first = 0
    for i, part in enumerate(EVENTS):
        put(spark, f"{tmp_path}/log", part, first)
        first += len(part)
        section = {"hiveTableName": "resumed_t"}
        run_sync(spark, config(tmp_path, "hive", checkpoint=f"c{i}", **section), once=True).awaitTermination()
    rows = spark.table("resumed_t")
    assert rows.columns == ["id", "name", "op", "ts"] and rows.count() == 10
    assert changes.current_rows(
        envelope.flatten(readers.record_log(spark, f"{tmp_path}/log", streaming=False), COLUMNS), "id", COLUMNS
    ).count() == 2


def test_last_per_key_on_a_stream_equals_the_batch(spark, tmp_path):
    fill(spark, f"{tmp_path}/log")

    def last(streaming):
        options = {"maxFilesPerTrigger": 1} if streaming else {}
        log = readers.record_log(spark, f"{tmp_path}/log", streaming=streaming, **options)
        good = envelope.accepted(envelope.decode(log, COLUMNS, key="id"))
        return changes.last_per_key(good, "id", ["op", "id", "name"])

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/last")

    finish(for_each_batch(last(True), write, f"{tmp_path}/c", "complete"))
    assert set(map(tuple, spark.read.parquet(f"{tmp_path}/last").collect())) == set(map(tuple, last(False).collect()))


def test_the_program(spark, tmp_path):
    from streamsync.__main__ import main

    fill(spark, f"{tmp_path}/log")
    document = {
        "syncSpark": {"sparkAppName": "app", "interval": 1, "writeType": "file"},
        "syncColumns": [{"colIndex": 1, "typeName": "number", "colName": "id"}],
        "syncFile": {
            "checkpointLocation": f"{tmp_path}/c", "format": "csv", "writePath": f"{tmp_path}/out",
            "options": {"nullValue": "-"},
        },
        "syncSource": {"path": f"{tmp_path}/log"},
    }
    (tmp_path / "job.json").write_text(json.dumps(document))
    main(["file", str(tmp_path / "job.json"), "once"])
    assert spark.read.csv(f"{tmp_path}/out").count() == 10
    with pytest.raises(SystemExit):
        main(["file"])
