"""Jobs: a source, an operator and a sink wired into one streaming query."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from streamsync.config import KafkaSource, SyncConfig
from streamsync.operators import envelope, telemetry
from streamsync.operators.casting import cast_columns, cast_failure
from streamsync.operators.offsets import EARLIEST, after, seed, starting_offsets
from streamsync.scratch import file_system
from streamsync.sinks import catalog, jdbc
from streamsync.sinks.atomic import AtomicFiles
from streamsync.sinks.files import check_checkpoint, file_stream
from streamsync.sinks.snapshot import SnapshotTable
from streamsync.sources import readers
from streamsync.streaming.batches import LOOSE_BATCHES, State, atomic_writer, batch_writer, query_id


def start(writer: DataStreamWriter, interval: int | None = None) -> StreamingQuery:
    """T4: every ``interval`` seconds for ever, or through all that is there and stop."""
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval} seconds").start()


def finish(writer: DataStreamWriter) -> None:
    """Run a query through all its input and wait for it."""
    start(writer).awaitTermination()


def for_each_batch(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """A micro-batch writer with checkpointed progress."""
    check_checkpoint(checkpoint)
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )


def read_log(spark: SparkSession, config: SyncConfig, state: State | AtomicFiles | None) -> DataFrame:
    """The configured record log from the recorded positions on.

    The positions a query begins with are kept beside its checkpoint and hold for all its
    starts: the batches of the checkpoint go on from there, also when the first of them
    failed.  A checkpoint without them is a query that began at the log's beginning.
    """
    positions = _seed_positions(spark, config, state)
    if config.source is not None:
        log = readers.record_log(spark, config.source.path, config.source.fmt, **config.source.options)
        return log if positions is None else after(log, positions)
    return readers.kafka(spark, kafka_options(config.kafka, positions))


def _seed_positions(spark: SparkSession, config: SyncConfig, state: State | AtomicFiles | None) -> DataFrame | None:
    """One row per log partition."""
    kept = f"{config.file.checkpoint.rstrip('/')}_seed"
    fs, done = file_system(spark, f"{kept}/_SUCCESS")
    if fs.exists(done):
        return spark.read.schema("topic string, partition int, next_offset bigint").parquet(kept)
    _, begun = file_system(spark, f"{config.file.checkpoint}/offsets")
    if fs.exists(begun) or state is None or not state.begun(spark):
        return None
    # fixed here while the job records new ones
    found = state.positions(spark)
    positions = spark.createDataFrame(found.collect(), found.schema)
    positions.coalesce(1).write.mode("overwrite").parquet(kept)
    return positions


def kafka_options(kafka: KafkaSource, positions: DataFrame | None) -> dict[str, str]:
    """The topic from the recorded positions on, else from the default offset.

    Kafka wants a position for every partition of the topic.  With a known number
    of partitions, one that had no record yet starts at its beginning.
    """
    topic: dict[str, str] = {"topic": kafka.topic, "starting_offsets": kafka.default_offset}
    here = None if positions is None else positions.where(F.col("topic") == kafka.topic)
    if here is not None and not here.isEmpty():
        if kafka.partitions is None:
            topic["starting_offsets"] = starting_offsets(here).first()[0]
        else:
            assign, starts = seed(here, {kafka.topic: kafka.partitions}, missing=EARLIEST)
            topic = {"assign": assign, "starting_offsets": starts}
    return readers.kafka_options(
        kafka.brokers,
        max_offsets_per_trigger=kafka.max_offsets_per_trigger,
        min_partitions=kafka.min_partitions,
        **topic,
    )


def sync_writer(spark: SparkSession, config: SyncConfig) -> Callable[[DataFrame, int], None]:
    """How one batch of flat changes is written, by ``writeType``."""
    columns = config.columns
    if config.write_type == "hive":
        table = f"{config.file.database}.{config.file.table}" if config.file.database else config.file.table
        path = config.file.path or None
        hive = spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"
        provider = config.file.provider or ("hive" if hive else "parquet")

        def to_table(rows: DataFrame, batch_id: int) -> None:
            stored = _projected(rows, config)
            if config.file.exactly_once:
                query = query_id(spark)
                catalog.write_batch(stored, table, batch_id, provider, path, query)
            else:
                catalog.append(stored, table, provider, path)

        return to_table
    if config.write_type == "jdbc" and config.save_mode == "append":

        def to_rows(rows: DataFrame, batch_id: int) -> None:
            jdbc.append_batch(rows, config.jdbc, config.app, batch_id, query_id(spark))

        return to_rows
    if config.write_type == "jdbc":
        prepared = []

        def to_keys(rows: DataFrame, batch_id: int) -> None:
            order = config.one_partition_per_key
            jdbc.sync(
                rows, config.jdbc, config.pk, config.types, prepare=not prepared, one_partition_per_key=order
            )
            prepared.append(batch_id)

        return to_keys
    if config.write_type == "snapshot":
        table = SnapshotTable(
            spark, config.file.path, config.pk, config.file.buckets, config.one_partition_per_key
        )
        table.log.claim()

        def to_buckets(rows: DataFrame, batch_id: int) -> None:
            table.apply(cast_columns(rows, config.types), query_id(spark), batch_id)

        return to_buckets
    raise ValueError(f"invalid writeType {config.write_type!r}")


def _projected(rows: DataFrame, config: SyncConfig) -> DataFrame:
    """P5: what the sink stores; the record columns are the configured ones, if any are."""
    if config.meta is None:
        return envelope.for_sink(rows, config.write_type, config.columns)
    names = [f"`{n}`" for n in config.columns]
    if config.write_type == "file":
        return rows.select("op", *names, *config.meta)
    return rows.select(*names, "op", *config.meta)


class Job:
    """The streaming queries of one job, as one."""

    def __init__(self, *queries: StreamingQuery):
        self.queries = queries

    def awaitTermination(self) -> None:  # noqa: N802 - as a query calls it
        """Until all have ended; when one fails the others are stopped, and its error raised."""
        running = list(self.queries)
        try:
            while running:
                # a query's own wait raises its error
                running = [q for q in running if not q.awaitTermination(1)]
        except Exception:
            self.stop()
            raise

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def run_sync(
    spark: SparkSession, config: SyncConfig, once: bool = False
) -> Job:
    """The change-data-capture job of a configuration, started.

    ``once`` reads what is there and stops; otherwise it runs every
    ``config.interval`` seconds.  A file job writes each row exactly once, by the file
    sink; where it has a state, a second query over the same log records its positions
    and its quarantine.  With ``atomic`` its rows, positions and quarantine are committed
    together instead.
    """
    check_checkpoint(config.file.checkpoint)
    interval = None if once else config.interval
    if config.write_type == "file" and config.file.atomic:
        return _run_atomic(spark, config, interval)
    state = State(config.state_path, config.app).claim(spark) if config.state_path else None
    if state is not None:
        state.condense(spark, LOOSE_BATCHES)
    log = read_log(spark, config, state)
    decode = _decoder(config)
    recorded = partial(batch_writer, decode, envelope.accepted, envelope.quarantined, state=state)
    if config.write_type != "file":
        handle = recorded(sync_writer(spark, config))
        return Job(start(for_each_batch(log, handle, config.file.checkpoint), interval))
    rows = _projected(envelope.accepted(decode(log)), config)
    writer = file_stream(
        rows, config.file.path, config.file.checkpoint, config.file.fmt,
        config.file.mode, config.file.partition_by, config.file.output_files, **config.file.options,
    )
    queries = [start(writer, interval)]
    if state is not None:
        if once:  # positions are recorded of what is written
            queries[0].awaitTermination()
        handle = recorded(lambda rows, batch_id: None)
        checkpoint = f"{config.file.checkpoint.rstrip('/')}_state"
        queries.append(start(for_each_batch(log, handle, checkpoint), interval))
    return Job(*queries)


def _decoder(config: SyncConfig) -> Callable[[DataFrame], DataFrame]:
    typed = config.write_type == "snapshot" or config.write_type == "jdbc" and config.save_mode == "upsert"
    return partial(
        envelope.decode,
        columns=config.columns,
        ops=config.ops,
        key=config.pk,
        check=cast_failure(config.types, config.pk) if typed else None,
    )


def atomic_files(spark: SparkSession, config: SyncConfig) -> AtomicFiles:
    """Where a file job with ``atomic`` keeps its rows, quarantine and positions."""
    return AtomicFiles(spark, config.file.path, config.file.fmt, config.file.partition_by, **config.file.options)


def _run_atomic(spark: SparkSession, config: SyncConfig, interval: int | None) -> Job:
    """A file job whose positions are those of its files, by one commit a batch."""
    table = atomic_files(spark, config)
    table.log.claim()
    log = read_log(spark, config, table)
    rows = lambda decoded: _projected(envelope.accepted(decoded), config)
    handle = atomic_writer(_decoder(config), rows, envelope.quarantined, table)
    return Job(start(for_each_batch(log, handle, config.file.checkpoint), interval))


def run_telemetry(
    log: DataFrame,
    table: str,
    checkpoint: str,
    state: State | None = None,
    provider: str = "parquet",
    path: str | None = None,
    interval: int | None = 30,
) -> StreamingQuery:
    """The telemetry job: signal rows of each batch appended to a catalog table, started."""

    def write(rows: DataFrame, batch_id: int) -> None:
        catalog.append(rows, table, provider, path)

    handle = batch_writer(telemetry.decode, telemetry.accepted, telemetry.quarantined, write, state)
    return start(for_each_batch(log, handle, checkpoint), interval)


def run_jdbc_append(
    rows: DataFrame,
    target: jdbc.JdbcTarget,
    app: str,
    checkpoint: str,
    mode: str = "append",
    pk: str | None = None,
    interval: int | None = 10,
) -> StreamingQuery:
    """K9: a stream into a JDBC table by output mode: append, complete or update by key."""
    if mode == "update" and pk is None:
        raise ValueError("update mode needs a key")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if mode == "append":
                jdbc.append_batch(kept, target, app, batch_id, query_id(batch.sparkSession))
            elif mode == "complete":
                jdbc.overwrite(kept, target)
            else:
                jdbc.create_table(batch.sparkSession, target, kept.drop("op").schema, pk)
                jdbc.upsert(kept, target, pk)
        finally:
            kept.unpersist()

    return start(for_each_batch(rows, write, checkpoint, mode), interval)
