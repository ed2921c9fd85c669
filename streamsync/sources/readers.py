"""Sources.  Every function gives a streaming or a batch DataFrame of the same shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The record log's columns, as a Kafka source gives them.
LOG_SCHEMA = "value string, topic string, partition int, offset bigint, timestamp timestamp"


def kafka_options(
    brokers: str,
    topic: str | None = None,
    assign: str | None = None,
    pattern: str | None = None,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka source.

    Exactly one of a topic list, an ``assign`` JSON and a topic pattern is given.
    ``max_offsets_per_trigger`` bounds a micro-batch after a long stop;
    ``min_partitions`` splits the offset range of a large log partition over
    several tasks.
    """
    given = {"subscribe": topic, "assign": assign, "subscribePattern": pattern}
    chosen = {k: v for k, v in given.items() if v is not None}
    if len(chosen) != 1:
        raise ValueError("give exactly one of topic, assign and pattern")
    options = {
        "kafka.bootstrap.servers": brokers,
        **chosen,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """A Kafka source; needs the Kafka connector on the class path."""
    options = dict(options)
    if not streaming and options.get("startingOffsets") == "latest":
        options["startingOffsets"] = "earliest"
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    streaming: bool = True,
    **options: object,
) -> DataFrame:
    """S3: JSON, CSV, ORC or Parquet files with a declared schema."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(schema).options(**options).load(path)


def record_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = True,
    **options: object,
) -> DataFrame:
    """S1 without Kafka: the same record columns read from files."""
    return files(spark, path, LOG_SCHEMA, fmt, streaming, **options)


def text_lines(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    timestamp: bool = False,
    **options: object,
) -> DataFrame:
    """Text lines as ``value``, with the file's time as ``timestamp`` if asked.

    The file's time is the same when a batch is repeated, unlike the clock.
    """
    reader = spark.readStream if streaming else spark.read
    lines = reader.options(**options).text(path)
    if not timestamp:
        return lines.select("value")
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def socket_lines(
    spark: SparkSession, host: str, port: int, timestamp: bool = False
) -> DataFrame:
    """Text lines from a socket, optionally with their arrival time."""
    return (
        spark.readStream.format("socket")
        .options(host=host, port=port, includeTimestamp=timestamp)
        .load()
    )


def rate(
    spark: SparkSession, rows_per_second: int = 1, ramp_up: str = "0s", partitions: int = 2
) -> DataFrame:
    """Made-up rows ``timestamp, value`` at a fixed rate."""
    return (
        spark.readStream.format("rate")
        .options(rowsPerSecond=rows_per_second, rampUpTime=ramp_up, numPartitions=partitions)
        .load()
    )


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def kept_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """T5: what a stopped query's stateful operator keeps after its last batch: ``key`` and
    ``value`` structs and the state's partition."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def bind(rows: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns by name, in its order and with its types."""
    return rows.to(schema)
