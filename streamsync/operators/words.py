"""Text lines to words and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.functions.decoding import once
from streamsync.functions.text import java_split, without_empty_tail


def words(lines: DataFrame) -> DataFrame:
    """One row per space-separated word of ``value``."""
    return lines.select(F.explode(java_split(F.col("value"), " ")).alias("value"))


def timed_words(lines: DataFrame) -> DataFrame:
    """One row per word between non-word characters, with the line's ``timestamp``."""
    split = lines.select(F.split("value", r"\W+").alias("parts"), "timestamp")
    return split.select(F.explode(without_empty_tail(F.col("parts"))).alias("word"), "timestamp")


def word_count(rows: DataFrame) -> DataFrame:
    """G1: running count per word, as SQL over the stream or table of words."""
    return rows.sparkSession.sql(
        "SELECT value, count(*) AS `count` FROM {rows} GROUP BY value", rows=rows
    )


def stamped_words(lines: DataFrame) -> DataFrame:
    """``timestamp,word`` lines to ``ts`` and ``word``, with ``reason`` for bad ones."""
    split = lines.select(once(java_split(F.col("value"), ",")).alias("parts"), "value")
    parts = F.col("parts")
    ts = F.get(parts, 0).try_cast("timestamp_ntz")
    word = F.get(parts, 1)
    return split.select(
        ts.alias("ts"),
        word.alias("word"),
        F.when(word.isNull(), "no word").when(ts.isNull(), "no time").alias("reason"),
        F.when(word.isNull() | ts.isNull(), F.col("value")).alias("value"),
    )


def adults_by_name(people: DataFrame, age: int = 18) -> DataFrame:
    """How many people older than ``age`` carry each name."""
    return people.where(F.col("age") > age).groupBy("name").count()
