import json

import pytest

from streamsync.config import load, parse
from streamsync.operators import offsets
from streamsync.scratch import work_dir
from streamsync.sources import readers


def document(**changes):
    base = {
        "syncSpark": {"sparkAppName": "app", "interval": 10, "writeType": "JDBC"},
        "syncColumns": [
            {"colIndex": 2, "typeName": "string", "colName": "name"},
            {"colIndex": 1, "typeName": "number", "colName": " id "},
        ],
        "syncFile": {"format": "csv", "writeMode": "append", "writePath": "/out", "checkpointLocation": "/c"},
        "syncKafka": {"kafkaBootstrapServers": "h:1", "kafkaTopic": "t", "initDefaultOffset": "latest"},
        "syncJdbc": {"pk": "id", "saveMode": "upsert", "jdbcUrl": "jdbc:x", "table": "t"},
    }
    for path, value in changes.items():
        section, _, key = path.partition("__")
        base[section][key] = value
    return json.dumps(base)


def test_columns_come_in_index_order():
    config = parse(document())
    assert list(config.types.items()) == [("id", "number"), ("name", "string")]
    assert (config.write_type, config.pk, config.jdbc.table, config.interval) == ("jdbc", "id", "t", 10)


@pytest.mark.parametrize(
    "change",
    [
        {"syncSpark__writeType": "redis"},
        {"syncJdbc__pk": "key"},
        {"syncJdbc__saveMode": "replace"},
        {"syncColumns": None},
        {"syncSpark__writeType": "file", "syncFile__writeMode": "complete"},
        {"syncSpark__writeType": "file", "syncFile__format": "avro"},
        {"syncSpark__writeType": "file", "syncFile__writePath": ""},
        {"syncSpark__writeType": "hive"},
        {"syncSpark__ops": ["x"]},
        {"syncSpark__recordColumns": ["key"]},
        {"syncKafka__topic": "t"},
        {"syncFile__compression": "gzip"},
    ],
)
def test_wrong_configurations_are_refused(change):
    if "syncColumns" in change:
        raw = json.loads(document())
        raw["syncColumns"][0]["typeName"] = "blob"
        text = json.dumps(raw)
    else:
        text = document(**change)
    with pytest.raises(ValueError):
        parse(text)


def test_the_keys_of_a_document():
    config = parse(document(
        syncSpark__ops=["c", "r"], syncSpark__recordColumns=["ts"], syncFile__metastoreUris="thrift://m:1",
        syncFile__tableProvider="parquet", syncFile__outputFiles=4, syncFile__exactlyOnce=True,
        syncJdbc__onePartitionPerKey=False, syncJdbc__keyLength=700,
    ))
    assert (config.ops, config.meta, config.one_partition_per_key) == (("c", "r"), ("ts",), False)
    assert (config.file.metastore, config.file.provider) == ("thrift://m:1", "parquet")
    assert (config.file.output_files, config.file.exactly_once, config.jdbc.key_length) == (4, True, 700)
    assert parse(document(syncSpark__writeType="file")).pk is None


def test_load_from_a_file(spark, tmp_path):
    path = tmp_path / "job.json"
    path.write_text(json.dumps(json.loads(document()), indent=2))
    assert load(spark, "file", str(path)) == parse(document())
    with pytest.raises(ValueError):
        load(spark, "ftp", str(path))


def test_kafka_options():
    options = readers.kafka_options("h:1", topic="t", starting_offsets='{"t":{"0":5}}', min_partitions=8)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": '{"t":{"0":5}}',
        "failOnDataLoss": "false", "minPartitions": "8",
    }
    assert readers.kafka_options("h:1", pattern="t.*")["subscribePattern"] == "t.*"
    with pytest.raises(ValueError):
        readers.kafka_options("h:1", topic="t", pattern="t.*")


def test_seed_lists_every_partition(spark):
    big = 2**31 + 5
    positions = spark.createDataFrame(
        [("t", 0, 12), ("t", 2, big), ("t", 10, 4), ("s", 1, 7)], "topic string, partition int, next_offset bigint"
    )
    assign, starts = offsets.seed(positions, {"t": 3})
    assert json.loads(assign) == {"t": [0, 1, 2]}
    assert json.loads(starts) == {"t": {"0": 12, "1": 0, "2": big}}
    text = offsets.starting_offsets(positions).first()[0]
    assert text == '{"s":{"1":7},"t":{"0":12,"2":%d,"10":4}}' % big


def test_kafka_goes_on_at_the_recorded_positions(spark):
    from streamsync.config import KafkaSource
    from streamsync.streaming.jobs import kafka_options

    positions = spark.createDataFrame(
        [("t", 0, 12), ("s", 0, 1)], "topic string, partition int, next_offset bigint"
    )
    known = KafkaSource("h:1", "t", "latest", partitions=2, max_offsets_per_trigger=1000)
    options = kafka_options(known, positions)
    assert json.loads(options["assign"]) == {"t": [0, 1]} and "subscribe" not in options
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 12, "1": -2}}
    assert options["maxOffsetsPerTrigger"] == "1000"
    unknown = kafka_options(KafkaSource("h:1", "t"), positions)
    assert unknown["subscribe"] == "t" and json.loads(unknown["startingOffsets"]) == {"t": {"0": 12}}
    for none in (None, positions.where("topic = 's'")):
        assert kafka_options(known, none)["startingOffsets"] == "latest"


def test_next_offset_is_a_long(spark):
    df = spark.createDataFrame([("t", "0", str(2**31)), ("t", "0", "9")], "topic string, partition string, offset string")
    assert offsets.next_offsets(df).first().next_offset == 2**31 + 1


def test_records_after_a_position(spark):
    log = spark.createDataFrame(
        [("t", 0, 1), ("t", 0, 2), ("t", 1, 1), ("u", 0, 0)], "topic string, partition int, offset bigint"
    )
    at = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, next_offset bigint")
    rest = offsets.after(log, at)
    assert {tuple(r) for r in rest.collect()} == {("t", 0, 2), ("t", 1, 1), ("u", 0, 0)}
    assert "Exchange" not in rest._jdf.queryExecution().executedPlan().toString()
    assert offsets.after(log, at.limit(0)).count() == 4


def test_text_lines_with_the_time_of_their_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    rows = readers.text_lines(spark, str(tmp_path), streaming=False, timestamp=True).collect()
    assert [r.value for r in rows] == ["one", "two"] and rows[0].timestamp == rows[1].timestamp
    assert readers.text_lines(spark, str(tmp_path), timestamp=True).isStreaming


def test_people_csv(spark, tmp_path):
    (tmp_path / "people.csv").write_text("31,Ada\n54,Grace\n")
    rows = readers.files(spark, str(tmp_path), "id bigint, name string", "csv", streaming=False).collect()
    assert [tuple(r) for r in rows] == [(31, "Ada"), (54, "Grace")]


def test_rate_and_socket_sources_are_streams(spark):
    assert readers.rate(spark, rows_per_second=5).columns == ["timestamp", "value"]


def test_work_dir_is_under_the_shared_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
