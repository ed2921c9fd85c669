"""Log positions: what was read, and where to go on."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the offset that means a partition's beginning.
EARLIEST = -2


def next_offsets(records: DataFrame) -> DataFrame:
    """The offset after the last record of each topic and partition, as a long."""
    return records.groupBy(
        F.col("topic"), F.col("partition").cast("int").alias("partition")
    ).agg((F.max(F.col("offset").cast("bigint")) + 1).alias("next_offset"))


def topic_totals(records: DataFrame) -> DataFrame:
    """Records per topic."""
    return records.groupBy("topic").agg(F.count("*").alias("n"))


def progress(records: DataFrame, **counts: Column) -> DataFrame:
    """G5, G6 in one pass: records, next offset and further counts per topic and partition."""
    return records.groupBy(
        F.col("topic"), F.col("partition").cast("int").alias("partition")
    ).agg(
        (F.max(F.col("offset").cast("bigint")) + 1).alias("next_offset"),
        F.count("*").alias("n"),
        *(c.alias(name) for name, c in counts.items()),
    )


def latest_offsets(recorded: DataFrame, app: str) -> DataFrame:
    """The position an application recorded last for each topic and partition."""
    return recorded.where(F.col("app") == app).groupBy("topic", "partition").agg(
        F.max_by("next_offset", F.struct("recorded_at", "batch_id")).alias("next_offset")
    )


def running_totals(recorded: DataFrame) -> DataFrame:
    """Records per application and topic over all recorded batches, a repeated one once."""
    once = recorded.groupBy("app", "query_id", "batch_id", "topic", "partition").agg(
        F.max("n").alias("n")
    )
    return once.groupBy("app", "topic").agg(F.sum("n").alias("total"))


def starting_offsets(positions: DataFrame) -> DataFrame:
    """One row, the JSON text a Kafka source takes as ``startingOffsets``.

    ``positions`` has one row per topic and partition, a number the Kafka cluster
    bounds and that does not grow with the records.
    """
    per_topic = positions.groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("partition", "next_offset"))).alias("parts")
    )
    whole = per_topic.agg(F.sort_array(F.collect_list(F.struct("topic", "parts"))).alias("topics"))
    entries = F.transform(
        "topics",
        lambda t: F.struct(
            t["topic"],
            F.map_from_entries(
                F.transform(t["parts"], lambda p: F.struct(p["partition"].cast("string"), p["next_offset"]))
            ),
        ),
    )
    return whole.select(F.to_json(F.map_from_entries(entries)).alias("starting_offsets"))


def seed(
    positions: DataFrame, partitions: Mapping[str, int], missing: int = 0
) -> tuple[str, str]:
    """``assign`` and ``startingOffsets`` for topics with a known number of partitions.

    Every partition is listed; one without a recorded position starts at
    ``missing``.  Reads one small row per partition.
    """
    known = {(r.topic, r.partition): r.next_offset for r in positions.collect()}
    assign = {t: list(range(n)) for t, n in partitions.items()}
    starts = {t: {str(p): known.get((t, p), missing) for p in ps} for t, ps in assign.items()}
    return json.dumps(assign), json.dumps(starts)


def after(log: DataFrame, positions: DataFrame) -> DataFrame:
    """T8 for a log kept in files: the records at or after the recorded positions.

    ``positions`` has one row per log partition; they become a constant of the filter,
    so no record crosses a shuffle.
    """
    at = [x for r in positions.collect() for x in (F.lit(f"{r.partition} {r.topic}"), F.lit(r.next_offset))]
    if not at:
        return log
    here = F.concat_ws(" ", F.col("partition").cast("string"), F.col("topic"))
    known = F.try_element_at(F.create_map(*at), here)
    return log.where(F.col("offset") >= F.coalesce(known, F.lit(0)))
