"""M1-M4: rewrite a folder of many small Parquet files as few large ones."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from streamsync.scratch import file_system

MIB = 1024 * 1024


def partition_count(spark: SparkSession, path: str, target_mib: int = 256) -> int:
    """M2: how many files of the target size a folder fills, one at least."""
    fs, place = file_system(spark, path)
    mib = fs.getContentSummary(place).getLength() // MIB
    return max(1, mib // target_mib)


def coalesce_count(spark: SparkSession, glob: str, target_mib: int) -> int:
    """M3: the same from the entries a pattern matches, rounded up past whole targets."""
    fs, place = file_system(spark, glob)
    mib = sum(status.getLen() for status in fs.globStatus(place) or []) // MIB
    return mib // target_mib + 1


def _state(spark: SparkSession, path: str) -> tuple[int, int]:
    fs, place = file_system(spark, path)
    summary = fs.getContentSummary(place)
    return summary.getFileCount(), summary.getLength()


class _Swap:
    """The exchange of a folder for its rewritten form, with a marker that tells a later
    run how far it came.  Only what the marker names is ever moved or deleted."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        parent, _, name = self.path.rpartition("/")
        self.spark, self.marker = spark, f"{parent}/.{name}.compaction"
        self.fs, _ = file_system(spark, self.path)

    def at(self, path: str) -> JavaObject:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def places(self, run: str) -> tuple[str, str]:
        return f"{self.path}_compact_{run}", f"{self.path}_old_{run}"

    def begin(self) -> tuple[str, str]:
        run = uuid.uuid4().hex
        out = self.fs.create(self.at(self.marker), True)
        out.write(json.dumps({"run": run}).encode())
        out.close()
        return self.places(run)

    def move(self, source: str, target: str) -> None:
        # into an existing folder some file systems would move it below that one
        if self.exists(target) or not self.fs.rename(self.at(source), self.at(target)):
            raise RuntimeError(f"cannot move {source} to {target}")

    def end(self, fresh: str, old: str) -> None:
        for place in (fresh, old, self.marker):
            self.fs.delete(self.at(place), True)

    def recover(self) -> None:
        """Finish or undo what a run that died has begun."""
        if not self.exists(self.marker):
            return
        reader = self.fs.open(self.at(self.marker))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
        reader.close()
        try:
            fresh, old = self.places(json.loads(text)["run"])
        except (ValueError, KeyError):  # died while it wrote the marker, before anything else
            self.fs.delete(self.at(self.marker), False)
            return
        if not self.exists(self.path) and self.exists(old):
            self.move(old, self.path)
        self.end(fresh, old)


def recover(spark: SparkSession, path: str) -> None:
    """M4: finish or undo what a compaction of this folder that died has begun."""
    _Swap(spark, path).recover()


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """The columns that a folder's ``name=value`` folders stand for, outermost first."""
    fs, place = file_system(spark, path)
    names: list[str] = []
    while True:
        below = [s.getPath() for s in fs.listStatus(place) if s.isDirectory()]
        keyed = [p for p in below if "=" in p.getName() and p.getName()[0] not in "._"]
        if not keyed:
            return names
        names.append(keyed[0].getName().split("=", 1)[0])
        place = keyed[0]


def whole_schema(spark: SparkSession, path: str, partitions: Sequence[str]) -> StructType:
    """The columns of all files together; partition values as the text they are."""
    files = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
    inner = [f for f in files.schema.fields if f.name not in partitions]
    return StructType([*inner, *(StructField(p, StringType()) for p in partitions)])


def packed(rows: DataFrame, files: int) -> DataFrame:
    """Rows of a folder in so many partitions, without a shuffle if the scan has that many: a
    task then reads whole pieces of files, about as many bytes as it writes."""
    many = rows.rdd.getNumPartitions()
    return rows.coalesce(files) if many >= files else rows.repartition(files)


def _differences(one: StructType, other: StructType) -> set[tuple[str, str]]:
    here, there = ({(f.name, f.dataType.simpleString()) for f in s.fields} for s in (one, other))
    return here ^ there


def compact(
    spark: SparkSession,
    path: str,
    target_mib: int = 256,
    partition_by: Sequence[str] = (),
    stream_stopped: bool = False,
    nested: bool = False,
    pattern: str | None = None,
) -> int:
    """M1, M4: compact a Parquet folder in place; gives the number of files written to.

    All columns that any file has are kept, and partition values letter by letter.  A
    folder partitioned by columns is refused unless ``partition_by`` names them; it is
    rebalanced by them, which splits a large partition over several files.  Any other
    folder is dealt out evenly over as many files as its size fills (with ``pattern``:
    the size of the entries that it matches).  The new folder replaces the old one by
    two renames, after rows and columns agree and nothing else has changed the folder.
    A folder a file stream writes to is refused unless the caller says the stream has
    ended.  ``nested`` takes the files of all folders below and ignores the folders' names.
    """
    swap = _Swap(spark, path)
    swap.recover()
    path = swap.path
    if swap.exists(f"{path}/_spark_metadata") and not stream_stopped:
        raise RuntimeError(f"{path} belongs to a file stream; stop it and pass stream_stopped=True")
    found = [] if nested else partition_names(spark, path)
    if found != list(partition_by):
        raise ValueError(f"{path} is partitioned by {found}, not by {list(partition_by)}")
    before = _state(spark, path)
    files = partition_count(spark, path, target_mib)
    if pattern is not None:
        files = coalesce_count(spark, pattern, target_mib)
    schema = whole_schema(spark, path, found)
    reader = spark.read.schema(schema)
    if nested or not found:  # a stream's list of its files may name an older state
        reader = reader.option("recursiveFileLookup", True)
    rows = reader.parquet(path)
    fresh, old = swap.begin()
    try:
        if found:
            rows.hint("rebalance", *found).write.partitionBy(*found).parquet(fresh)
        else:
            packed(rows, files).write.parquet(fresh)
        same_rows = rows.count() == spark.read.schema(schema).parquet(fresh).count()
        lost = _differences(schema, whole_schema(spark, fresh, found))
        if not same_rows or lost or _state(spark, path) != before:
            raise RuntimeError(f"{path} changed while it was compacted; nothing was replaced")
        swap.move(path, old)
        try:
            swap.move(fresh, path)
        except Exception:
            swap.move(old, path)
            raise
    except Exception:
        if swap.exists(path):
            swap.end(fresh, old)
        raise
    swap.end(fresh, old)
    spark.catalog.refreshByPath(path)
    return files


def compact_table(spark: SparkSession, table: str, target_mib: int = 256) -> DataFrame:
    """S7 + M1: compact the folder of a catalog table and give the table again."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    path = detail.where("col_name = 'Location'").first()["data_type"]
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    compact(spark, path, target_mib, columns)
    spark.catalog.refreshTable(table)
    return spark.table(table)
