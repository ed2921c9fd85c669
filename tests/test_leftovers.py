"""What a JDBC job left when it died, and errors that are no missing table."""

import uuid

import pytest

from streamsync.sinks import catalog, jdbc


def target(spark, create=True):
    """An embedded database of this process."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    more = ";create=true" if create else ""
    return jdbc.JdbcTarget(f"jdbc:derby:memory:{uuid.uuid4().hex}{more}", "people")


def test_own_leftovers_go_and_others_stay(spark):
    to = target(spark)
    rows = spark.createDataFrame([(1, "a")], "id bigint, name string")
    context = spark.sparkContext
    try:
        context.setLocalProperty("sql.streaming.queryId", "mine")
        mine = jdbc.stage(rows, to, "id")
        context.setLocalProperty("sql.streaming.queryId", "theirs")
        theirs = jdbc.stage(rows, to, "id")
        context.setLocalProperty("sql.streaming.queryId", "mine")
        flat = spark.createDataFrame(
            [("c", "1", "a", "2024-01-01 00:00:00", "0", "0")],
            "op string, id string, name string, ts string, partition string, offset string",
        )
        jdbc.sync(flat, to, "id", {"id": "number", "name": "string"})
        assert not jdbc.table_exists(spark, mine) and jdbc.table_exists(spark, theirs)
        assert jdbc.drop_leftovers(spark, to) == []
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)
    assert jdbc.drop_leftovers(spark, to) == [] and jdbc.read(spark, to).count() == 1


def test_an_unreachable_database_is_no_missing_table(spark):
    with pytest.raises(Exception):
        jdbc.drop_table(spark, target(spark, create=False))
    there = target(spark)
    assert not jdbc.drop_table(spark, there)
    assert not jdbc.table_exists(spark, jdbc.JdbcTarget(there.url, "people", schema="nowhere"))


def test_a_quote_in_the_place_of_a_table(spark, tmp_path):
    path = f"{tmp_path}/it's"
    catalog.write_batch(spark.createDataFrame([(1,)], "id bigint"), "quoted_t", 0, path=path)
    assert spark.read.parquet(path).count() == 1
    spark.sql("DROP TABLE quoted_t")


def test_ranges_of_uneven_keys_hold_as_many_rows(spark):
    to = target(spark)
    keys = [*range(1000), *(i * 10**12 for i in range(1, 100)), *[7_777] * 300, None, None]
    jdbc.overwrite(spark.createDataFrame([(k,) for k in keys], "id bigint"), to)
    found = jdbc.balanced_ranges(spark, to, "id", 10)
    parts = [r[0] for r in jdbc.read_balanced(spark, to, "id", 10).rdd.mapPartitions(lambda p: [(sum(1 for _ in p),)]).collect()]
    assert sum(parts) == len(keys) and len(parts) == len(found)
    mean = len(keys) / 10
    assert sorted(parts)[-1] <= 300 + mean and sorted(parts)[-2] <= 2 * mean  # one value has 300
    none = target(spark)
    jdbc.overwrite(spark.createDataFrame([], "id bigint"), none)
    assert jdbc.read_balanced(spark, none, "id", 4).count() == 0
