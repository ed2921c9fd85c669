import datetime
import random
import re

from pyspark.sql import functions as F

from streamsync.functions.text import java_split, last_segment, without_empty_tail
from streamsync.operators import telemetry, windows, words

# What Java's String.split gives.
SPACE = {
    "": [""], " ": [], "   ": [], "a": ["a"], " a": ["", "a"], "a ": ["a"], "a  b": ["a", "", "b"],
    "  a b  ": ["", "", "a", "b"], "a\n": ["a\n"], "é ü": ["é", "ü"], "a\t b": ["a\t", "b"],
}
NONWORD = {
    "": [""], "!?": [], "a": ["a"], "!a": ["", "a"], "a!!": ["a"], "a, b": ["a", "b"],
    "é": [], "aéb": ["a", "b"], "a\n": ["a"], "a!\n!": ["a"], "a_b-c": ["a_b", "c"],
}
COMMA = {",": [], "a,": ["a"], "a,b,": ["a", "b"], "a,,\n": ["a", "", "\n"], ",a": ["", "a"], "a,,": ["a"]}


def split_all(spark, cases, split):
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    return {r.v: r.p for r in df.select("v", split(F.col("v")).alias("p")).collect()}


def test_java_split(spark):
    assert split_all(spark, SPACE, lambda c: java_split(c, " ")) == SPACE
    assert split_all(spark, COMMA, lambda c: java_split(c, ",")) == COMMA
    assert split_all(spark, NONWORD, lambda c: without_empty_tail(F.split(c, r"\W+"))) == NONWORD


def java_parts(text, pattern):
    parts = re.split(pattern, text)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_random_texts_split_as_java_does(spark):
    rng = random.Random(3)
    texts = {"".join(rng.choice(" ,a!\nb.") for _ in range(rng.randrange(9))) for _ in range(3000)}
    for separator in " ,.":
        want = {t: java_parts(t, re.escape(separator)) for t in texts}
        assert split_all(spark, texts, lambda c: java_split(c, separator)) == want
    want = {t: java_parts(t, r"\W+") for t in texts}
    assert split_all(spark, texts, lambda c: without_empty_tail(F.split(c, r"\W+"))) == want
    last = {t: (java_parts(t, r"\.") or [t])[-1] for t in texts}
    assert split_all(spark, texts, last_segment) == last


def test_long_runs_of_separators_take_linear_time(spark):
    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit("-"), 2_000_000), F.lit("b")).alias("v"))
    lines = df.select(F.col("v").alias("value"), F.lit(0).alias("timestamp"))
    assert [r.word for r in words.timed_words(lines).collect()] == ["a", "b"]
    spaces = df.select(F.translate("v", "-", " ").alias("value"))
    assert words.words(spaces).where("value <> ''").count() == 2


def test_last_segment(spark):
    cases = {"gps.lat": "lat", "gps.": "gps", "...": "...", "none": "none", "a.b.c": "c", ".a": "a", "": "", "a..": "a"}
    assert split_all(spark, cases, last_segment) == cases


def signal_rows(spark, texts):
    return spark.createDataFrame(
        [(t, "s", 0, i) for i, t in enumerate(texts)],
        "value string, topic string, partition int, offset bigint",
    )


SIGNALS = [
    '{"val":"7.5","st":"rolling.engTrq","rc":"204","ct":"K9","oem":"K","vin":"car-a","ts":1700000000123}',
    '{"st":"gps.lat","vin":"car-b","val":"51.25","ts":"1700000032456000","ct":"K9","oem":"K"}',
    '{"st":"gps.lat","ts":"157"}',
    '{"st":"gps.lat"}',
    '{"note":"gps.","ts":1700000000123}',
    'gps. not json',
    '{"st":"body.door","ts":1700000000123}',
    '{"st":"...","ts":1700000000123,"note":"gps."}',
    '{"st":"gps.x","ts":"170000000012x"}',
    '{"st":"gps.x","ts":"-170000000012"}',
    '{"st":"gps.x","ts":1700000000123,"val":{"a":1}}',
    None,
]


def test_telemetry(spark):
    log = signal_rows(spark, SIGNALS)
    rows = telemetry.ingest(log).collect()
    assert rows[0].asDict().keys() == set(telemetry.COLUMNS) and list(rows[0].asDict()) == list(telemetry.COLUMNS)
    got = [(r.st, r.sts, r.ts_time, r.value, r.rc) for r in rows]
    assert got == [
        ("rolling.engTrq", "engTrq", "2023-11-15 06:13:20", "7.5", "204"),
        ("gps.lat", "lat", "2023-11-15 06:13:52", "51.25", None),
        ("...", "...", "2023-11-15 06:13:20", None, None),
        ("gps.x", "x", "1964-08-12 17:46:39", None, None),
        ("gps.x", "x", "2023-11-15 06:13:20", '{"a":1}', None),
    ]
    assert {(r.province, r.city, r.knk_flag) for r in rows} == {(None, None, "N")}
    assert len({r.data_id for r in rows}) == len(rows)
    bad = telemetry.quarantined(telemetry.decode(log)).collect()
    assert {(r.offset, r.reason) for r in bad} == {
        ("2", "no event time"), ("3", "no event time"), ("4", "no signal"), ("5", "no signal"), ("8", "no event time"),
    }
    assert telemetry.decode(log).count() == len(SIGNALS)


def test_repeatable_and_random_ids(spark):
    log = signal_rows(spark, SIGNALS[:2])
    ids = lambda **kw: {r.data_id for r in telemetry.ingest(log, **kw).collect()}
    assert ids() == ids()
    assert ids(deterministic_id=False).isdisjoint(ids(deterministic_id=False))


def test_times_do_not_depend_on_the_session_zone(spark):
    log = signal_rows(spark, SIGNALS[:1])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert telemetry.ingest(log).first().ts_time == "2023-11-15 06:13:20"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_signal_filters(spark):
    rows = telemetry.ingest(signal_rows(spark, SIGNALS))
    assert telemetry.with_signal(rows, "lat").count() == 1
    assert telemetry.with_full_signal(rows, "GPS.Lat").count() == 1


def test_ten_by_five_minute_windows(spark):
    lines = ["2021-07-03 17:30:10,tide", "2021-07-03 17:33:59,tide", "2021-07-03 17:36:00,ebb", "no comma", "x,y"]
    parsed = words.stamped_words(spark.createDataFrame([(v,) for v in lines], "value string"))
    bad = parsed.where("reason is not null").collect()
    assert [(r.value, r.reason) for r in bad] == [("no comma", "no word"), ("x,y", "no time")]
    counted = windows.count_by_window(parsed.where("reason is null"), "ts", "word", "10 minutes", "5 minutes")
    rows = windows.sorted_windows(counted, "word").collect()
    at = lambda minute: datetime.datetime(2021, 7, 3, 17, minute)
    assert [(r.start, r.word, r.n) for r in rows] == [
        (at(25), "tide", 2), (at(30), "ebb", 1), (at(30), "tide", 2), (at(35), "ebb", 1),
    ]


def test_adults(spark):
    people = spark.createDataFrame([("a", 18), ("a", 19), ("b", 30), ("b", None)], "name string, age bigint")
    assert {tuple(r) for r in words.adults_by_name(people).collect()} == {("a", 1), ("b", 1)}
