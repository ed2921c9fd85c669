"""Document fingerprints by content-defined chunking.

A 16-bit gear hash runs over a text's bytes; since each step shifts it by one bit, it
depends on the last 16 bytes only, and is computed for all places at once.  A chunk ends
where the hash's upper bits are zero: five of them before the normal size, three after
it, never below the least nor above the largest size.  Boundaries depend on what stands
near them, so an insertion changes only the chunks around it.

A fingerprint is the set of the chunks' digests with their lengths.  How much of a text
is contained in another one is the length of the chunks they share, as a part of its own.
"""

from __future__ import annotations

import bisect
import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import small_batches, stored

LEAST, NORMAL, MOST = 8, 24, 96
HARD_BITS, EASY_BITS = 5, 3
#: Bytes hashed at once; a longer text is cut at chunk ends.
SLICE = 1 << 20
#: Bytes before a place that its gear hash depends on.
BEFORE = 15
#: Documents of consecutive ids in one run of the stream, and runs at most: with over 400
#: million documents runs are longer.  A run is sorted by Spark and streamed, never held.
RUN_ROWS, RUNS = 4096, 100_000

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_GEAR = _RANDOM.integers(0, 1 << 16, 256, dtype=np.uint16)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64)
_POWER = np.cumprod(np.full(MOST, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
_CHUNK = np.dtype([("digest", ">u4"), ("length", "u1")])


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte."""
    value = _GEAR[data]
    for step in (1, 2, 4, 8):
        before = value.copy()
        value[step:] += before[:-step] << np.uint16(step)
    return value


def ends(data: np.ndarray, before: int = 0) -> list[int]:
    """The ends of a text's chunks, the last of them its own; its first ``before`` bytes only
    count for the hash of those that follow."""
    value = gear(data)[before:]
    easy = (np.flatnonzero(value < (1 << 16 - EASY_BITS)) + 1).tolist()
    hard = (np.flatnonzero(value < (1 << 16 - HARD_BITS)) + 1).tolist()
    easy.append(1 << 62)
    hard.append(1 << 62)
    size, begin, found, find = len(value), 0, [], bisect.bisect_left
    while begin < size:
        end = hard[find(hard, begin + LEAST)]
        if end >= begin + NORMAL:
            end = min(easy[find(easy, begin + NORMAL)], begin + MOST)
        begin = min(end, size)
        found.append(begin)
    return found


def chunks(text: str) -> np.ndarray:
    """The set of a text's chunks by rising digest: (digest, length)."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    parts, begin = [], 0
    while begin < len(data):
        part = data[begin : begin + SLICE]
        before = min(begin, BEFORE)
        cut = np.array(ends(data[begin - before : begin + SLICE], before))
        if begin + SLICE < len(data):
            cut = cut[:-1]  # may go on after the slice
        part, starts = part[: cut[-1]], np.concatenate([[0], cut[:-1]])
        lengths = cut - starts
        place = np.arange(len(part)) - np.repeat(starts, lengths)
        total = np.add.reduceat(_BYTE[part] * _POWER[place], starts)
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        found = np.empty(len(cut), _CHUNK)
        found["digest"], found["length"] = total >> np.uint64(32), lengths
        parts.append(found)
        begin += int(cut[-1])
    if not parts:
        return np.empty(0, _CHUNK)
    every = np.concatenate(parts)
    _, first = np.unique(every["digest"], return_index=True)
    return every[first]


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """The part of ``one``'s length in chunks that ``other`` has; of no chunks, all of it
    if ``other`` has none either, else nothing."""
    if not len(one):
        return float(not len(other))
    shared = np.isin(one["digest"], other["digest"], assume_unique=True)
    return float(one["length"][shared].sum(dtype=np.int64) / one["length"].sum(dtype=np.int64))


def parse(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), _CHUNK)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def _row(doc_id, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> dict:
    changed = edited(text, following)
    changed_chunks = own if changed == text else chunks(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
        "fingerprint": own.tobytes().hex(),
        "edited_fingerprint": changed_chunks.tobytes().hex(),
        "near_edited": containment(own, changed_chunks),
        "near_next": containment(own, theirs),
    }


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by run and place; each is compared with the next one of its run."""
    last = None
    for batch in batches:
        rows = []
        columns = [batch.column(c) for c in ("run", "doc_id", "text")]
        for values in zip(*columns):
            run, doc_id, text = (v.as_py() for v in values)
            own = chunks(text)
            if last is not None and last[0] == run:
                rows.append(_row(*last[1:], text, own))
            last = run, doc_id, text, own
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RESULT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next of every row.

    A null text counts as empty.  The next document is the next row by (doc_id, text),
    null ids first; after the last row comes the first, which is its own next one when
    there are no others.  Rows of one doc_id stay in one run, which is streamed.
    """
    small_batches(docs.sparkSession)
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), place.alias("place"))
    n = rows.count()
    runs = min(RUNS, -(-n // RUN_ROWS))
    edges = [float("-inf")]
    if runs > 1:
        known = rows.filter("doc_id is not null")
        shares = [i / runs for i in range(1, runs)]
        edges += sorted({x for x in known.approxQuantile("place", shares, 0.1 / runs)})
    bucket = Bucketizer(splits=[*edges, float("inf")], inputCol="place", outputCol="bucket")
    placed = (bucket.transform(rows) if len(edges) > 1 else rows.withColumn("bucket", F.lit(0.0))).select(
        F.col("bucket").cast("int").alias("run"), F.lit(0).alias("ahead"), "doc_id", "text"
    )

    # the first row of each run stands once more at the end of the run before
    firsts = stored(
        placed.groupBy("run").agg(F.min(F.struct("doc_id", "text")).alias("first")), "first-documents"
    )
    order = sorted(r["run"] for r in firsts.select("run").collect())  # RUNS at most
    if not order:
        return placed.limit(0).mapInArrow(_compare, _ddl())
    pairs = [(run, order[i - 1]) for i, run in enumerate(order)]
    before = docs.sparkSession.createDataFrame(pairs, "at int, before int")
    ahead = firsts.join(F.broadcast(before), F.col("run") == F.col("at")).select(
        F.col("before").alias("run"), F.lit(1).alias("ahead"), "first.*"
    )
    stream = (
        placed.unionByName(ahead)
        .repartition(max(1, len(order)), "run")
        .sortWithinPartitions("run", "ahead", F.asc_nulls_first("doc_id"), "text")
    )
    return stream.mapInArrow(_compare, _ddl())


def _ddl() -> str:
    return (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
