"""M1 in steps: only the small files of a folder are rewritten, by bins of about one target."""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.maintenance.compact import MIB
from streamsync.scratch import file_system

#: A file of so much of the target is left as it is.
FULL = 0.75


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files to merge with each other: first fit by falling size.  Bins of one file are left out."""
    found: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        at = next((i for i, (used, _) in enumerate(found) if used + size <= target), None)
        if at is None:
            found.append((size, [name]))
        else:
            used, names = found[at]
            found[at] = (used + size, [*names, name])
    return [names for _, names in found if len(names) > 1]


class _Journal:
    """The files a compaction puts in place and those it removes, written before either.

    A run that died is finished if all its new files are there, else undone.
    """

    def __init__(self, spark: SparkSession, path: str):
        parent, _, name = path.rpartition("/")
        self.spark, self.path, self.marker = spark, path, f"{parent}/.{name}.incremental"
        self.fs, _ = file_system(spark, path)

    def at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def begin(self, work: str, moves: list[tuple[str, str]], gone: list[str]) -> dict:
        plan = {"work": work, "moves": moves, "gone": gone}
        draft = self.at(f"{self.marker}-{uuid.uuid4().hex}")
        out = self.fs.create(draft, True)
        out.write(json.dumps(plan).encode())
        out.close()
        if not self.fs.rename(draft, self.at(self.marker)):
            raise RuntimeError(f"another compaction of {self.path} is running or has died; call recover")
        return plan

    def finish(self, plan: dict) -> None:
        """New files first, then the old ones go: a reader in between sees rows twice, never
        none; readers that must not, read while no compaction runs."""
        for source, target in plan["moves"]:
            if not self.fs.exists(self.at(target)) and not self.fs.rename(self.at(source), self.at(target)):
                raise RuntimeError(f"cannot move {source} to {target}")
        for old in plan["gone"]:
            self.fs.delete(self.at(old), False)
        self.fs.delete(self.at(plan["work"]), True)
        self.fs.delete(self.at(self.marker), False)

    def recover(self) -> None:
        if not self.fs.exists(self.at(self.marker)):
            return
        reader = self.fs.open(self.at(self.marker))
        plan = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8"))
        reader.close()
        # the plan is written after all new files are, so it can always be finished
        self.finish(plan)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what an incremental compaction of this folder that died has begun."""
    _Journal(spark, path.rstrip("/")).recover()


def small_files(spark: SparkSession, path: str, target: int) -> dict[str, dict[str, int]]:
    """Sizes of the Parquet files below FULL of the target, by their folder."""
    fs, place = file_system(spark, path)
    found: dict[str, dict[str, int]] = defaultdict(dict)
    listing = fs.listFiles(place, True)
    while listing.hasNext():
        status = listing.next()
        place, size = status.getPath().toString(), status.getLen()
        folder, _, name = place.rpartition("/")
        if not name.startswith(("_", ".")) and size < FULL * target:
            found[folder][place] = size
    return found


def compact_incremental(spark: SparkSession, path: str, target_mib: float = 256) -> int:
    """Merge the small files of each folder of a Parquet table; gives the number of files that
    came in their place.

    The listing alone decides: files of three quarters of the target or more keep their name
    and are not read; the others are merged in bins of one target at most, within their
    folder, so partition values stay letter by letter; a file that fits with no other is left.
    All bins are one Spark job that shuffles the rows of small files only.  Nothing is done
    where nothing is to merge, so it costs a listing to run it often.  A folder a file stream
    writes to is refused, and so is a bin whose rows do not come out as many as went in.
    """
    path = path.rstrip("/")
    journal = _Journal(spark, path)
    journal.recover()
    if journal.fs.exists(journal.at(f"{path}/_spark_metadata")):
        raise RuntimeError(f"{path} belongs to a file stream, which lists its own files")
    target = int(target_mib * MIB)
    merged = [
        (folder, names) for folder, sizes in small_files(spark, path, target).items() for names in bins(sizes, target)
    ]
    if not merged:
        return 0
    every = [name for _, names in merged for name in names]
    # rows find their bin by the file they lie in; the list of files is small
    listed = [(name, i) for i, (_, names) in enumerate(merged) for name in names]
    bin_of = spark.createDataFrame(listed, "file string, _bin int")
    rows = _rows_of(spark, every)
    dealt = rows.join(F.broadcast(bin_of), F.col("_file") == F.col("file")).drop("_file", "file")
    parent, _, name = path.rpartition("/")
    work = f"{parent}/.{name}_incremental_{uuid.uuid4().hex}"
    try:
        # a bin is a task of its own, whose one file needs no order of the rows
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", 8):
            dealt.repartitionById(len(merged), F.col("_bin")).write.partitionBy("_bin").parquet(work)
        written = spark.read.parquet(work)
        if written.count() != spark.read.option("mergeSchema", True).parquet(*every).count():
            raise RuntimeError(f"{path} changed while it was compacted; nothing was replaced")
        moves = []
        for i, (folder, _) in enumerate(merged):
            for status in journal.fs.listStatus(journal.at(f"{work}/_bin={i}")):
                if status.getPath().getName().endswith(".parquet"):
                    moves.append((status.getPath().toString(), f"{folder}/{status.getPath().getName()}"))
        if len({target for _, target in moves}) < len(moves):
            raise RuntimeError("two merged files have the same name; nothing was replaced")
    except Exception:
        journal.fs.delete(journal.at(work), True)
        raise
    journal.finish(journal.begin(work, moves, every))
    spark.catalog.refreshByPath(path)
    return len(moves)


@contextmanager
def setting(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    """A setting of the session while something is written."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _rows_of(spark: SparkSession, names: list[str]) -> DataFrame:
    """The rows of some files, with all columns that any has, and their file."""
    rows = spark.read.option("mergeSchema", True).parquet(*names)
    place = F.col("_metadata.file_path")
    # the listing and the reader may write the scheme's slashes differently
    plain = F.regexp_replace(place, "^([a-z][a-z0-9+.-]*):/+", "$1:/")
    return rows.select("*", F.url_decode(F.regexp_replace(plain, r"\+", "%2B")).alias("_file"))
