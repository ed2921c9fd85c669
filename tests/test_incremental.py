"""Incremental compaction and late rows."""

import os

import pytest
from pyspark.sql import functions as F

from streamsync.maintenance import incremental
from streamsync.maintenance.incremental import bins, compact_incremental
from streamsync.plans import tables
from streamsync.streaming.jobs import finish
from streamsync.streaming.late import batch_watermark, late_rows


def parquet_files(path):
    return {
        os.path.join(d, n): os.path.getsize(os.path.join(d, n))
        for d, _, names in os.walk(path)
        for n in names
        if n.endswith(".parquet")
    }


def test_bins_hold_a_target_at_most():
    sizes = {f"f{i}": size for i, size in enumerate([60, 50, 40, 30, 30, 20, 99])}
    found = bins(sizes, 100)
    assert all(sum(sizes[n] for n in names) <= 100 and len(names) > 1 for names in found)
    assert len({n for names in found for n in names}) == sum(map(len, found))
    assert bins({"a": 80, "b": 90}, 100) == [] and bins({}, 100) == []
    assert bins({"a": 0, "b": 0}, 100) == [["a", "b"]]


def test_large_files_keep_their_names_and_small_ones_merge(spark, tmp_path):
    path = f"{tmp_path}/t"
    wide = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("a b+c=%/").alias("p"))
    wide.coalesce(1).write.partitionBy("p").parquet(path)
    (large,) = parquet_files(path)
    for i in range(6):
        rows = spark.range(i * 10, i * 10 + 10).select("id", F.lit("y").alias("x"), F.lit("a b+c=%/" if i % 2 else "q").alias("p"))
        rows.coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before = sorted(map(tuple, spark.read.parquet(path).select("id", "x", "p").where("id < 100").collect()))
    assert compact_incremental(spark, path, target_mib=1) == 2
    after = parquet_files(path)
    assert large in after and len(after) == 3
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "x", "p").where("id < 100").collect())) == before
    assert compact_incremental(spark, path, target_mib=1) == 0
    assert parquet_files(path) == after
    assert not [n for n in os.listdir(tmp_path) if "incremental" in n]


def test_bins_of_one_folder_do_not_take_each_others_name(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(96_000).select("id", F.rand(1).alias("x")).repartition(48).write.parquet(path)
    before = spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first()
    target = max(parquet_files(path).values()) * 2.5 / 1024 / 1024
    merged = compact_incremental(spark, path, target_mib=target)
    after = parquet_files(path)
    assert merged == len(after) == 24
    # each was written by a task of its own
    assert len({os.path.basename(name)[:10] for name in after}) == merged
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first() == before


def test_more_rows_make_more_small_files(spark, monkeypatch):
    counts = []
    monkeypatch.setattr(tables, "compact_incremental", lambda s, path, target_mib: counts.append(len(parquet_files(path))))
    sf = "/root/testdata/sf0.01"
    tables.compact_incremental_(spark, sf)
    monkeypatch.setattr(tables, "SMALL_ROWS", 2_000)
    assert tables.compact_incremental_(spark, sf).count() == 60_000
    assert counts[0] == 4 * 7 and counts[2] == 15 * 7


def test_files_of_different_columns_merge(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5).coalesce(1).write.parquet(path)
    spark.range(5).withColumn("more", F.lit("m")).coalesce(1).write.mode("append").parquet(path)
    assert compact_incremental(spark, path) == 1
    assert spark.read.parquet(path).where("more = 'm'").count() == 5 and spark.read.parquet(path).count() == 10


@pytest.mark.parametrize("moved", [0, 1])
def test_a_compaction_that_died_is_finished(spark, tmp_path, monkeypatch, moved):
    path = f"{tmp_path}/t"
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(path)
    finish_ = incremental._Journal.finish

    def die(self, plan):
        if moved:
            for source, target in plan["moves"]:
                self.fs.rename(self.at(source), self.at(target))
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental._Journal, "finish", die)
    with pytest.raises(RuntimeError):
        compact_incremental(spark, path)
    monkeypatch.setattr(incremental._Journal, "finish", finish_)
    incremental.recover(spark, path)
    spark.catalog.refreshByPath(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2] and len(parquet_files(path)) == 1


def test_a_streams_folder_is_refused(spark, tmp_path):
    os.makedirs(f"{tmp_path}/t/_spark_metadata")
    with pytest.raises(RuntimeError):
        compact_incremental(spark, f"{tmp_path}/t")


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_rows_behind_the_watermark_are_set_aside(spark, tmp_path, slide):
    schema = "ts timestamp, n long"
    arrivals = [
        [("2024-01-01 10:00:00", 1), ("2024-01-01 12:10:00", 2)],
        [("2024-01-01 09:59:00", 3), ("2024-01-01 10:20:00", 4), ("2024-01-01 11:40:00", 5), (None, 6)],
        [("2024-01-01 08:00:00", 7)],
    ]
    for rows in arrivals:
        made = spark.createDataFrame(rows, "ts string, n long").withColumn("ts", F.col("ts").cast("timestamp"))
        made.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        finish(late_rows(stream, "ts", "1 hour", "1 hour", f"{tmp_path}/late", f"{tmp_path}/c", slide))
    # the watermark of the second batch is 11:10; 10:20 lies in a window to 11:00, or to 11:00 sliding
    late = {r.n for r in spark.read.schema(schema).parquet(f"{tmp_path}/late").collect()}
    assert late == {3, 4, 7}
    assert batch_watermark(spark, f"{tmp_path}/c", 0) == 0
