import json

import pytest
from pyspark.sql import functions as F

from streamsync.operators import casting, changes, envelope

COLUMNS = ["id", "name"]


def record(text, offset, partition=0):
    return (text, "t", partition, offset, None)


def log(spark, texts):
    return spark.createDataFrame(
        [record(t, i) for i, t in enumerate(texts)],
        "value string, topic string, partition int, offset bigint, timestamp timestamp",
    )


def event(op, before=None, after=None):
    return json.dumps({"payload": {"op": op, "before": before, "after": after}})


TEXTS = [
    event("c", None, {"id": 1, "name": "a"}),
    event("u", {"id": 1, "name": "a"}, {"id": 1, "name": "b"}),
    event("d", {"id": 1, "name": "b"}, None),
    event("r", None, {"id": 2, "name": "x"}),
    "not json",
    '{"op":"c","after":{"id":3}}',
    event("d", None, None),
    event("c", None, {"id": 1234567890123456789012, "name": None}),
    event("c", None, {"id": 4, "name": {"first": "n"}}),
    None,
    "",
]


def test_row_image_follows_the_operation(spark):
    rows = envelope.flatten(log(spark, TEXTS), COLUMNS).orderBy(F.col("offset").cast("int")).collect()
    assert [(r.op, r.id, r.name) for r in rows] == [
        ("c", "1", "a"),
        ("u", "1", "b"),
        ("d", "1", "b"),
        ("d", None, None),
        ("c", "1234567890123456789012", None),
        ("c", "4", '{"first":"n"}'),
    ]


def test_binary_values_are_read_as_text(spark):
    text = log(spark, TEXTS)
    binary = text.withColumn("value", F.col("value").cast("binary"))
    rows = lambda df: sorted(map(str, envelope.decode(df, COLUMNS, key="id").collect()))
    assert rows(binary) == rows(text)


def test_quarantine_has_the_raw_text_and_the_reason(spark):
    decoded = envelope.decode(log(spark, TEXTS), COLUMNS, key="id")
    rows = envelope.quarantined(decoded).collect()
    assert {(r.offset, r.reason) for r in rows} == {
        ("3", "unsupported op"),
        ("4", "unreadable"),
        ("5", "unreadable"),
        ("6", "missing key"),
        ("10", "unreadable"),
    }
    assert {r.value for r in rows} == {TEXTS[i] for i in (3, 4, 5, 6, 10)}
    assert decoded.count() == len(TEXTS)


def test_each_record_is_parsed_once(spark):
    plan = envelope.flatten(log(spark, TEXTS), COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_names_are_trimmed_and_checked():
    assert envelope.clean_names([" id ", "name"]) == ["id", "name"]
    for bad in (["op"], ["id", "ID"], ["a", ""], ["Partition"]):
        with pytest.raises(ValueError):
            envelope.clean_names(bad)


def test_odd_column_names(spark):
    text = event("c", None, {"a.b": 1, "c d": "x"})
    flat = envelope.flatten(log(spark, [text]), ["a.b", "c d"])
    assert flat.first()[1:3] == ("1", "x")
    assert envelope.for_sink(flat, "jdbc", ["a.b", "c d"]).columns == ["a.b", "c d", "op"]


def test_sink_columns(spark):
    flat = envelope.flatten(log(spark, TEXTS), COLUMNS)
    assert envelope.for_sink(flat, "HIVE", COLUMNS).columns == ["id", "name", "op", "ts"]
    assert envelope.for_sink(flat, "jdbc", COLUMNS).columns == ["id", "name", "op"]
    assert envelope.for_sink(flat, "file", COLUMNS).columns == [
        "op", "id", "name", "ts", "topic", "partition", "offset",
    ]


def test_types(spark):
    df = spark.createDataFrame(
        [("12", "0", "1.50"), ("-7", "1571639105009", "x"), ("1.0", "x", None), (" 3", None, "2"),
         (None, "99999999999999999", "3.14159"), ("9223372036854775808", "-1", "1e3")],
        "n string, d string, m string",
    )
    out = casting.cast_columns(df, {"n": "NUMBER", "d": "date", "m": "decimal(6,2)"}).collect()
    assert [r.n for r in out] == [12, -7, None, None, None, None]
    assert [str(r.d) for r in out] == [
        "1970-01-01 00:00:00", "2019-10-21 06:25:05.009000", "None", "None", "None",
        "1969-12-31 23:59:59.999000",
    ]
    assert [str(r.m) for r in out] == ["1.50", "None", "None", "2.00", "3.14", "1000.00"]
    kept = casting.cast_columns(df, {"m": "decimal", "n": "string"})
    assert [r.m for r in kept.collect()][:2] == ["1.50", "x"]
    with pytest.raises(ValueError):
        casting.check_type("int")


def test_a_bad_value_does_not_stop_its_delete(spark):
    df = spark.createDataFrame(
        [("c", "1", "x"), ("d", "1", "x"), ("d", "k", "1"), ("u", "2", None)], "op string, id string, n string"
    )
    reason = casting.cast_failure({"id": "number", "n": "number"}, "id")
    assert [r[0] for r in df.select(reason).collect()] == [
        "bad number in n", None, "bad number in id", None,
    ]


def test_last_change_wins_whatever_the_batches(spark):
    import random

    rng = random.Random(7)
    texts, state = [], {}
    for _ in range(600):
        key = rng.choice([1, rng.randrange(40)])
        if key in state and rng.random() < 0.3:
            texts.append(event("d", {"id": key, "name": state.pop(key)}, None))
        else:
            name = f"n{rng.randrange(1000)}"
            texts.append(event("u" if key in state else "c", None, {"id": key, "name": name}))
            state[key] = name
    flat = envelope.flatten(log(spark, texts), COLUMNS).repartition(7)
    got = {r.id: r.name for r in changes.current_rows(flat, "id", COLUMNS).collect()}
    assert got == {str(k): v for k, v in state.items()}


def test_a_key_in_several_partitions_goes_by_record_time(spark):
    rows = [("c", "1", "old", "2024-01-01 00:00:00", "0", "9"), ("u", "1", "new", "2024-01-02 00:00:00", "1", "2")]
    df = spark.createDataFrame(rows, "op string, id string, name string, ts string, partition string, offset string")
    last = changes.last_per_key(df, "id", one_partition_per_key=False)
    assert last.first().name == "new" and last.columns == df.columns


def test_hot_key_is_reduced_before_the_shuffle(spark):
    flat = envelope.flatten(log(spark, TEXTS), COLUMNS)
    for one in (True, False):
        last = changes.last_per_key(flat, "id", one_partition_per_key=one)
        plan = last._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Exchange hashpartitioning")
        assert "Final" in above and "Partial" in below and "WindowGroupLimit" in below


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    assert sorted(str(r.a) for r in changes.delete_where(df, "a > 3").collect()) == ["1", "None"]
