"""Helpers of several operators: stored tables, bounded samples, Latin text, free column names."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamsync.scratch import work_dir

#: Rows of one Arrow batch to a Python worker: whole texts of any length share its memory.
BATCH_ROWS = 512

#: The characters whose classes (letter, number, white space) and lower case are the same
#: in every Unicode version: ASCII, Latin-1 and Latin Extended-A but U+0130.
OUTSIDE_LATIN = re.compile("[^\t-\r -~\xa0-įı-ſ]")
LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-įı-ſ"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_SPACES = "\t-\r \xa0"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if not any(name.endswith("/streamsync-package.zip") for name in context.listFiles):
        package = Path(__file__).resolve().parents[1]
        base = os.path.join(tempfile.mkdtemp(), "streamsync-package")
        context.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that a Python worker holds at once, for texts of any length."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def give_back() -> None:
    """Return the memory that a finished task of a reused Python worker no longer needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def many_rows(spark: SparkSession, rows: int = 10_000) -> Iterator[None]:
    """Larger Arrow batches while rows of a few numbers are written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the folder all executors share and read from there.

    What follows does not run the steps before again when an executor is lost.
    """
    path = f"{work_dir(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of the table has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a value written as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def bounded_sample(
    df: DataFrame, key: str, per_key: int | dict, max_keys: int = 64
) -> DataFrame:
    """At most ``per_key`` different rows of each of the ``max_keys`` commonest values of
    ``key``, or of each value as many as a dict of limits says.

    Rows go by a hash of their values, so the choice is the same in every run.  A
    value with many different rows is thinned by that hash before its rows are ranked, and
    of equal rows each task passes on one, so that no group of copies meets in a task.
    """
    hashed, rank = free_name(df, "hashed"), free_name(df, "rank")
    rows = df.withColumn(hashed, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    counted = rows.groupBy(key).agg(F.count("*").alias(rank), F.approx_count_distinct(hashed, 0.02))
    counted = [(k, n) for k, _, n in counted.orderBy(F.desc(rank), F.asc(key)).limit(max_keys).collect()]
    if not counted:
        return df.limit(0)
    limits = per_key if isinstance(per_key, dict) else {k: per_key for k, _ in counted}
    counted = [(k, n) for k, n in counted if k in limits]
    if not counted:
        return df.limit(0)
    shares = F.create_map(
        *[F.lit(x) for k, n in counted for x in (k, min(1.0, (2.0 * limits[k] + 50) / n))]
    )
    limit = F.create_map(*[F.lit(x) for k, _ in counted for x in (k, limits[k])])[F.col(key)]
    picked = rows.filter(
        F.col(hashed).bitwiseAND((1 << 52) - 1) < F.try_element_at(shares, key) * float(1 << 52)
    ).dropDuplicates([key, hashed])
    ranks = F.row_number().over(Window.partitionBy(key).orderBy(hashed))
    return picked.withColumn(rank, ranks).filter(F.col(rank) <= limit).drop(rank, hashed)


def paragraphs(text: str, size: int):
    """A long text in pieces of about ``size`` characters, each ended before white space."""
    begin = 0
    while len(text) - begin > size:
        gap = _SPACE.search(text, begin + size)
        if gap is None:
            break
        yield text[begin : gap.start()]
        begin = gap.start()
    yield text[begin:]


_SPACE = re.compile(r"[\t-\r ]")
