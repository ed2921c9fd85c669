"""What happens to one micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.maintenance.compact import compact, recover
from streamsync.operators.envelope import REASON, SKIPPED
from streamsync.operators.offsets import latest_offsets, progress
from streamsync.scratch import file_system
from streamsync.sinks.atomic import AtomicFiles
from streamsync.sinks.commits import CommitLog

#: Folders of batches that a start of the job leaves as they are; more are merged.
LOOSE_BATCHES = 64

PROGRESS = (
    "topic string, partition int, next_offset bigint, n bigint, "
    "app string, query_id string, batch_id bigint, recorded_at timestamp"
)
QUARANTINE = "value string, topic string, partition string, offset string, reason string"


@dataclass(frozen=True)
class State:
    """Where an application keeps its positions and its quarantine.

    Each batch has its own folder, so a repeated batch replaces what it wrote.
    """

    path: str
    app: str
    claims: CommitLog | None = None

    def claim(self, spark: SparkSession) -> State:
        """The same state for its only writer: what an earlier writer of this application
        records from now on is refused."""
        log = CommitLog(spark, f"{self.path}/writers/{self.app}", lambda state, entry: state)
        log.claim()
        return replace(self, claims=log)

    def begun(self, spark: SparkSession) -> bool:
        fs, place = file_system(spark, f"{self.path}/progress")
        return fs.exists(place)

    def record(self, positions: DataFrame, query_id: str, batch_id: int) -> None:
        rows = positions.withColumns(
            {
                "app": F.lit(self.app),
                "query_id": F.lit(query_id),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "recorded_at": F.current_timestamp(),
            }
        )
        self._write(rows, "progress", query_id, batch_id)

    def quarantine(self, rows: DataFrame, query_id: str, batch_id: int) -> None:
        self._write(rows, "quarantine", query_id, batch_id)

    def _write(self, rows: DataFrame, kind: str, query_id: str, batch_id: int) -> None:
        if self.claims is not None:
            self.claims.check()
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={query_id}_{batch_id}")

    def _read(self, spark: SparkSession, kind: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{kind}")

    def recorded(self, spark: SparkSession) -> DataFrame:
        """All recorded positions, one row per batch, topic and partition; a batch that was
        written again after its first record was merged is there once."""
        rows = self._read(spark, "progress", PROGRESS)
        return rows.dropDuplicates(["app", "query_id", "batch_id", "topic", "partition"])

    def positions(self, spark: SparkSession) -> DataFrame:
        """Where to go on."""
        return latest_offsets(self.recorded(spark), self.app)

    def quarantined(self, spark: SparkSession) -> DataFrame:
        """All records set aside, each once."""
        return self._read(spark, "quarantine", QUARANTINE).dropDuplicates(["topic", "partition", "offset"])

    def condense(self, spark: SparkSession, loose: int = 0) -> None:
        """Merge the batches' folders into one file, where there are more than ``loose``.

        Run it while the job is stopped; a job does it whenever it starts, so its
        history is listed and read as a few files.
        """
        for kind in ("progress", "quarantine"):
            path = f"{self.path}/{kind}"
            recover(spark, path)
            fs, place = file_system(spark, path)
            if fs.exists(place) and len(fs.listStatus(place)) > loose:
                compact(spark, path, nested=True)


def query_id(spark: SparkSession) -> str:
    """The id of the running stream; it stays the same as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"


def batch_writer(
    decode: Callable[[DataFrame], DataFrame],
    accepted: Callable[[DataFrame], DataFrame],
    quarantined: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None],
    state: State | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a job.

    The decoded batch is kept while it is used, so the source is read and parsed
    once.  One small aggregate, a row per log partition, tells how many rows are
    good or bad; empty writes are left out.  Positions are recorded last, so a
    failure repeats the batch and loses nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        reason = REASON if REASON in decoded.columns else "reason"
        try:
            usable = F.count_if(F.col(reason).isNull())
            rejected = F.count_if(F.col(reason) != SKIPPED)
            seen = progress(decoded, good=usable, bad=rejected)
            rows = seen.collect()
            if any(r.good for r in rows):
                write(accepted(decoded), batch_id)
            if state is None:
                return
            spark = batch.sparkSession
            query = query_id(spark)
            if any(r.bad for r in rows):
                state.quarantine(quarantined(decoded), query, batch_id)
            if rows:
                known = pa.Table.from_pylist([r.asDict() for r in rows])
                positions = spark.createDataFrame(known, seen.schema).drop("good", "bad")
                state.record(positions.coalesce(1), query, batch_id)
        finally:
            decoded.unpersist()

    return handle


def atomic_writer(
    decode: Callable[[DataFrame], DataFrame],
    accepted: Callable[[DataFrame], DataFrame],
    quarantined: Callable[[DataFrame], DataFrame],
    table: AtomicFiles,
) -> Callable[[DataFrame, int], None]:
    """T7 for files: a batch's rows, quarantine and positions in one commit."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        reason = REASON if REASON in decoded.columns else "reason"
        try:
            usable = F.count_if(F.col(reason).isNull())
            rejected = F.count_if(F.col(reason) != SKIPPED)
            rows = progress(decoded, good=usable, bad=rejected).collect()  # one a log partition
            table.write(
                accepted(decoded) if any(r.good for r in rows) else None,
                quarantined(decoded) if any(r.bad for r in rows) else None,
                [(r.topic, r.partition, r.next_offset, r.n) for r in rows],
                query_id(batch.sparkSession),
                batch_id,
            )
        finally:
            decoded.unpersist()

    return handle


def replay(
    table: AtomicFiles,
    corrected: DataFrame,
    decode: Callable[[DataFrame], DataFrame],
    accepted: Callable[[DataFrame], DataFrame],
    query: str,
    batch: int = 0,
) -> bool:
    """Corrected records (value, topic, partition, offset, timestamp) enter again under
    their first positions.

    Only records that lie in the quarantine enter, and only if they can be used now; they
    leave it in the same commit that stores their rows, so each enters once.  ``query`` and
    ``batch`` name the replay: the same one is not done again.
    """
    keys = ["topic", "partition", "offset"]
    waiting = table.quarantined().select(*(F.col(k).cast("string").alias(f"_{k}") for k in keys)).distinct()
    same = [F.col(k).cast("string") == F.col(f"_{k}") for k in keys]
    decoded = decode(corrected.dropDuplicates(keys).join(waiting, same, "left_semi")).persist()
    reason = REASON if REASON in decoded.columns else "reason"
    try:
        usable = decoded.where(F.col(reason).isNull())
        if usable.isEmpty():
            return False
        done = usable.select(*(F.col(k).cast("string").alias(k) for k in keys))
        return table.write(accepted(decoded), None, [], query, batch, replayed=done)
    finally:
        decoded.unpersist()
