"""Word and window counts on batch input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.functions.decoding import once
from streamsync.operators import windows, words
from streamsync.plans.logs import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(words.words(documents(spark, sf_dir)))


WORD_COUNT = """
select "value", count(*) as "count" from (select unnest(
  case when regexp_full_match(text, ' +') then []
       else string_split(regexp_replace(text, ' +$', ''), ' ') end) as "value" from documents) group by 1"""


def word_count_nonword(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = documents(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("timestamp"))
    return words.timed_words(lines).groupBy("word").agg(F.count("*").alias("n"))


WORD_COUNT_NONWORD = r"""
select word, count(*) n from (select unnest(
  case when regexp_full_match(text, '\W+') then []
       else regexp_split_to_array(regexp_replace(text, '\W+$', ''), '\W+') end) word from documents) group by 1"""


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed text lines: type and properties of each event."""
    line = F.concat("event_type", F.lit(" "), "props")
    return table(spark, sf_dir, "events").select(line.alias("value"), F.col("ts").alias("timestamp"))


def sliding_4_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = words.timed_words(event_lines(spark, sf_dir))
    return windows.count_by_window(found, "timestamp", "word", "4 minutes", "2 minutes")


SLIDING_4_2 = r"""
select start, start + interval 4 minute as "end", word, count(*) n
from (select word, time_bucket(interval 2 minute, ts) - to_minutes(2*i) as start
      from (select ts, unnest(regexp_split_to_array(
              regexp_replace(event_type || ' ' || props, '\W+$', ''), '\W+')) word from events),
           range(2) t(i))
group by all"""


def timed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time,word`` lines; every 50th has no word, every 70th no readable time."""
    i = F.col("event_id")
    second = F.substring(F.col("ts").cast("string"), 1, 19)
    line = (
        F.when(i % 50 == 0, second)
        .when(i % 70 == 0, F.concat(F.lit("today,"), "event_type"))
        .otherwise(F.concat(second, F.lit(","), "event_type"))
    )
    return table(spark, sf_dir, "events").select(once(line).alias("value"))


def sliding_10_5_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = words.stamped_words(timed_lines(spark, sf_dir)).where("reason is null")
    counted = windows.count_by_window(good, "ts", "word", "10 minutes", "5 minutes")
    return windows.sorted_windows(counted, "word")


SLIDING_10_5_SORTED = """
select start, start + interval 10 minute as "end", word, count(*) n
from (select event_type word, time_bucket(interval 5 minute, ts) - to_minutes(5*i) as start
      from events, range(2) t(i) where event_id%50<>0 and event_id%70<>0)
group by all order by 1, 2, 3"""


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.stamped_words(timed_lines(spark, sf_dir)).where("reason is not null").select("value", "reason")


BAD_LINES = """
select case when event_id%50=0 then strftime(ts, '%Y-%m-%d %H:%M:%S') else 'today,' || event_type end as "value",
  case when event_id%50=0 then 'no word' else 'no time' end reason
from events where event_id%50=0 or event_id%70=0"""


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 without a slide."""
    return windows.count_by_window(table(spark, sf_dir, "events"), "ts", "event_type", "1 hour")


TUMBLING = """
select time_bucket(interval 1 hour, ts) as start, time_bucket(interval 1 hour, ts) + interval 1 hour as "end",
  event_type, count(*) n from events group by all"""


def filter_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.floor("value").alias("age"))
    return words.adults_by_name(people)


FILTER_GROUP_COUNT = """
select event_type as name, count(*) as "count" from events where floor("value") > 18 group by 1"""

QUERIES = {
    "word_count": (word_count, WORD_COUNT),
    "word_count_nonword": (word_count_nonword, WORD_COUNT_NONWORD),
    "sliding_4_2": (sliding_4_2, SLIDING_4_2),
    "sliding_10_5_sorted": (sliding_10_5_sorted, SLIDING_10_5_SORTED),
    "bad_lines": (bad_lines, BAD_LINES),
    "tumbling": (tumbling, TUMBLING),
    "filter_group_count": (filter_group_count, FILTER_GROUP_COUNT),
}
