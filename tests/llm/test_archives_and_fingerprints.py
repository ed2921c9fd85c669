import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamsync.llm import fingerprints, warc

PAGES = [
    (1, "http://a/ü\r\nX: y", "<html>é" * 400), (2, None, "<html>é" * 400), (3, "http://b/", "short"), (4, "http://b/", "short"),
    (5, "u", None), (6, "u", ""), (7, "u", "z" * 999), (8, "u", "z" * 999), (9, "u", "z" * 1000), (10, "u", "z" * 1000),
    (None, "u", "<html>é" * 400), (None, "n", "only " * 300), (11, "big", "0123456789" * 50_000), (12, "big2", "\r\n\r\nWARC/1.1\r\n" * 20_000),
    (13, "edge", "e" * warc.CHUNK), (14, "edge", "f" * (warc.CHUNK + 1)),
]


def pages_table(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", F.lit(1).alias("digest"), F.lit("r").alias("record_type"), F.lit(0).alias("chunk"), F.lit("k").alias("payload"))


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        keeper = max(same, default=None) if len(payload) >= 1000 else None
        refers = keeper if keeper is not None and page != keeper else None
        digest = hashlib.sha1(payload).hexdigest()
        out.append((str(page), len(payload), digest, "response" if refers is None else "revisit", str(refers)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def test_round_trip(spark):
    assert rows_of(warc.round_trip(pages_table(spark, PAGES))) == expected(PAGES)
    repeated = PAGES[2:4] * 3
    assert rows_of(warc.round_trip(pages_table(spark, repeated))) == expected(repeated)
    assert warc.round_trip(pages_table(spark, PAGES).limit(0)).count() == 0


def test_chunks_carry_digests_and_hold_no_whole_record(spark):
    archives = warc.write_archives(warc.deduplicated(warc.spooled(warc.chunked(pages_table(spark, PAGES)))))
    rows = warc.read_archives(archives).collect()
    assert archives.agg(F.sum("records")).first()[0] == len(PAGES)
    assert max(len(r.content) for r in rows) == warc.CHUNK
    for page, _, html in PAGES:
        own = sorted((r for r in rows if r.page_id == page and r.record_type == "response"), key=lambda r: (r.record, r.chunk))
        if page is None or not own:
            continue
        content = b"".join(r.content for r in own)
        assert content == (html or "").encode() and [r.last for r in own] == [False] * (len(own) - 1) + [True]
        for i, r in enumerate(own):
            before = b"".join(x.content for x in own[: i + 1])
            assert (r.bytes_so_far, r.digest_so_far) == (len(before), hashlib.sha1(before).hexdigest())


def test_only_places_and_digests_are_shuffled(spark):
    chunks = warc.chunked(pages_table(spark, PAGES))
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    assert chunks.agg(F.max(F.octet_length("content"))).first()[0] == warc.CHUNK
    records = warc.spooled(chunks)
    assert records.columns == ["page_id", "url", "n_bytes", "digest", "spool", "start"]
    for r in records.collect():
        html = next(h for p, _, h in PAGES if p == r.page_id and hashlib.sha1((h or "").encode()).hexdigest() == r.digest)
        with open(r.spool.removeprefix("file:"), "rb") as file:
            assert b"".join(warc._payload(file, r.start, r.n_bytes)) == (html or "").encode()
    with open(records.filter("page_id = 11").first().spool.removeprefix("file:"), "rb") as file, pytest.raises(EOFError):
        list(warc._payload(file, 1 << 40, 5))


def test_a_large_group_of_copies_and_a_long_payload(spark):
    rows = [(i, f"u{i}", "copy " * 300) for i in range(400)] + [(None, "n", "copy " * 300)] * 3
    rows += [(1000 + i, "u", f"é{i}" * 700_000) for i in range(2)] + [(2000, None, "é0" * 700_000)]
    assert rows_of(warc.round_trip(pages_table(spark, rows).repartition(5))) == expected(rows)


def test_archives_are_what_the_format_says(spark):
    archives = warc.write_archives(warc.deduplicated(warc.spooled(warc.chunked(pages_table(spark, PAGES[:6])))))
    for row in archives.collect():
        raw = open(row.path.removeprefix("file:"), "rb").read()
        assert len(raw) == row.stored_bytes
        text = gzip.decompress(raw)
        assert text.count(b"WARC/1.1\r\nWARC-Type: ") == row.records
        assert text.endswith(b"\r\n\r\n") and b"X: y\r\n" not in text


def test_a_cut_archive_is_an_error(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 50\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(record))
    with pytest.raises(EOFError):
        list(warc._read(str(tmp_path / "x.warc.gz")))
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(b"something else\r\n"))
    with pytest.raises(ValueError):
        list(warc._read(str(tmp_path / "y.warc.gz")))


def test_op7_on_the_tables(spark):
    from streamsync.llm import queries

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows_of(queries.op7_warc(spark, sf)) == expected(rows)


# fingerprints


def plain_gear(data):
    value, out = 0, []
    for b in data:
        value = ((value << 1) + int(fingerprints._GEAR[b])) & 0xFFFF
        out.append(value)
    return out


def plain_ends(data):
    """One byte after the other."""
    value, begin, out = plain_gear(data), 0, []
    for i in range(len(data)):
        size = i + 1 - begin
        hard = value[i] < (1 << 16 - fingerprints.HARD_BITS)
        easy = value[i] < (1 << 16 - fingerprints.EASY_BITS)
        if size >= fingerprints.LEAST and (hard if size < fingerprints.NORMAL else easy) or size >= fingerprints.MOST:
            out.append(i + 1)
            begin = i + 1
    return out + ([len(data)] if begin < len(data) else [])


def test_boundaries_equal_the_plain_rule():
    draw = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 95, 96, 97, 500, 5000):
        for data in (draw.integers(0, 256, n, dtype=np.uint8), draw.integers(97, 100, n, dtype=np.uint8), np.full(n, 65, np.uint8)):
            assert fingerprints.ends(data) == plain_ends(data.tolist())


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randrange(2, 8))) for _ in range(n))


def test_an_insertion_moves_few_chunks():
    draw = random.Random(1)
    text = words(draw, 800)
    own = fingerprints.chunks(text)
    for change in ("X" + text, text[:2000] + "inserted" + text[2000:], text + " more"):
        assert fingerprints.containment(own, fingerprints.chunks(change)) > 0.95
    assert fingerprints.containment(own, fingerprints.chunks(words(draw, 800))) < 0.05
    part = fingerprints.chunks(text[1000:2500])
    assert fingerprints.containment(part, own) > 0.9 > 0.5 > fingerprints.containment(own, part)


def test_slices_of_a_long_text_change_no_chunk(monkeypatch):
    text = words(random.Random(5), 3000) + "é日" * 200 + "a" * 3000
    whole = fingerprints.chunks(text)
    for size in (100, 128, 1000, 4096):
        monkeypatch.setattr(fingerprints, "SLICE", size)
        assert fingerprints.chunks(text).tobytes() == whole.tobytes()


def test_containment_of_nothing():
    none, some = fingerprints.chunks(""), fingerprints.chunks("abc")
    assert [fingerprints.containment(*x) for x in ((none, none), (none, some), (some, none), (some, some))] == [1, 0, 0, 1]


def check(rows, docs):
    """Against the texts in order: sizes, edited texts, equal prints, likenesses."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    texts = [t or "" for _, t in order]
    expected = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        own, edit, near = map(fingerprints.chunks, (text, changed, following))
        expected.append(
            (str(order[i][0]), len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), edit.tobytes().hex(),
             fingerprints.containment(own, edit), fingerprints.containment(own, near))
        )
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(expected)


def test_fingerprints_of_odd_rows(spark, documents):
    draw = random.Random(2)
    rows = [(5, None), (3, ""), (8, "abc"), (None, "x y z" * 30), (3, "same"), (3, "same"), (2**40, "é" * 999), (-4, "日本" * 50 + "\U0001f600")]
    rows += [(100 + i, words(draw, 5 + i)) for i in range(20)] + [(99, words(draw, 300_000))]
    docs = documents([(i, t, None, None) for i, t in rows])
    check([tuple(r) for r in fingerprints.fingerprints(docs).collect()], rows)
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0
    one = fingerprints.fingerprints(documents([(1, "only one text here", None, None)])).collect()
    assert one[0].near_next == 1.0 and one[0].n_chars == 18


def test_several_runs_meet_at_their_ends(spark, documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "RUN_ROWS", 7)
    draw = random.Random(4)
    ids = draw.sample(range(10**6), 60)
    rows = [(i, words(draw, draw.randrange(80))) for i in ids] + [(ids[0], "again")]
    docs = documents([(i, t, None, None) for i, t in rows]).repartition(3)
    check([tuple(r) for r in fingerprints.fingerprints(docs).collect()], rows)


def test_op8_on_the_tables(spark):
    from streamsync.llm import queries

    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [tuple(r) for r in queries.op8_fingerprints(spark, sf).collect()]
    check(rows, docs)
    assert np.mean([r[5] > 0.5 > r[6] for r in rows]) > 0.97
    assert all(fingerprints.parse(r[3]).tobytes().hex() == r[3] for r in rows)
