"""Near-duplicate texts by the Hamming distance of 64-bit fingerprints.

A fingerprint's bit is the majority of that bit over the hashes of all word shingles.  Two
fingerprints that differ in at most ``tau`` bits are found by the generalised pigeonhole:
cut the bits into m parts and give part i the threshold t_i, where the thresholds add up to
tau - m + 1; then the two are within t_i of each other in at least one part.  -1 leaves a part
out.  So a fingerprint looks up, in each part, all values within its threshold there, and
each fingerprint found is verified on all 64 bits.

Bits that go together, by their correlation over all fingerprints, lie in one part.  Each
fingerprint has thresholds of its own: a dynamic programme over the parts takes those with
the least work, the look-ups plus the candidates, whose number is estimated from histograms
of sub-parts of all fingerprints.  The number of parts is the one with the least estimated
work in all.

What is near in a part is dealt by that part's value.  A value that many fingerprints have is
dealt in blocks, each pair of blocks to a task, and a task gives no more links than it takes
to connect what is linked, so a large group gives no rows for its pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import many_rows, small_batches, stored
from streamsync.llm.components import components

#: Words of a shingle; seed of its hash; bits that may differ.
WIDTH, SEED, TAU = 4, 42, 4
#: Bits of a sub-part: its histogram has 2 ** SUB entries.
SUB = 11
#: Cost of a look-up, a row that is shuffled, against a candidate, a pair that is verified.
LOOKUP, VERIFY = 1.0, 0.05
#: Fingerprints of one value that one task compares with as many others.
BLOCK = 4096
#: Look-ups of a fingerprint made at once.
FLIPS = 64
#: Pairs compared at once.
PAIRS = 1 << 20
#: Bytes of a table that are given to all tasks at most.
BROADCAST = 8 << 20

_ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _hashes(text: str | None, width: int) -> np.ndarray:
    """The hashes of all shingles of a text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[min(width, len(words)) - 1 :]
    first = np.concatenate([[0], ends + 1])[: len(last)]
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist()))
    return np.fromiter(found, np.uint64, len(last))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), PAIRS // 8):
        part = np.ascontiguousarray(hashes[begin : begin + PAIRS // 8].astype("<u8"))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return int(value)


def fingerprints(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows without their text, with ``simhash`` (a long, two's complement) added.

    The shingles are those of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z, joined by
    spaces; fewer words than ``width`` are one; without any, also for null, it is zero.
    """
    small_batches(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name != text]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_majority(_hashes(t, width)) for t in batch.column(text).to_pylist()]
            arrays = [batch.column(f.name) for f in others]
            arrays.append(pa.array(np.array(values, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in others), "simhash"])

    return docs.mapInArrow(marked, docs.drop(text).schema.add("simhash", "long"))


# Bits that go together


def _correlation(prints: DataFrame) -> np.ndarray:
    """Correlations of the 64 bits over all fingerprints."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((65, 65))
        for batch in batches:
            values = batch.column(0).to_numpy().astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            wide = np.concatenate([bits, np.ones((len(bits), 1), np.uint8)], axis=1).astype(np.float32)
            total += wide.T @ wide
        places = pa.array(range(65 * 65), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel().astype(np.int64))], ["place", "n"])

    counts = prints.select("simhash").mapInArrow(together, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = np.zeros(65 * 65)
    for place, n in counts.collect():  # 4,225 rows
        found[place] = n
    found = found.reshape(65, 65)
    n = max(found[64, 64], 1)
    mean = found[64, :64] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return (found[:64, :64] / n - np.outer(mean, mean)) / np.outer(spread, spread)


def parts_of(correlation: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m parts of about the same size; a part grows by the bit that goes with
    its bits most."""
    alike = np.abs(correlation)
    free, parts = list(range(64)), []
    for i in range(m):
        size = (64 + m - 1 - i) // m
        strength = alike[np.ix_(free, free)].sum(axis=1)
        part = [free[int(np.argmax(strength))]]
        free.remove(part[0])
        while len(part) < size:
            nearest = free[int(np.argmax(alike[np.ix_(free, part)].sum(axis=1)))]
            part.append(nearest)
            free.remove(nearest)
        parts.append(sorted(part))
    return parts


def _values(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a part, as one number each."""
    out = np.zeros(len(prints), np.uint64)
    for i, bit in enumerate(bits):
        out |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(i)
    return out


def _pieces(part: list[int]) -> list[list[int]]:
    n = -(-len(part) // SUB)
    return [part[i * len(part) // n : (i + 1) * len(part) // n] for i in range(n)]


def _histograms(prints: DataFrame, pieces: list[list[int]]) -> list[np.ndarray]:
    """How many of all fingerprints have each value of each sub-part."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(bits), np.int64) for bits in pieces]
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for total, bits in zip(totals, pieces):
                total += np.bincount(_values(values, bits).astype(np.int64), minlength=len(total))
        for i, total in enumerate(totals):
            some = np.flatnonzero(total)
            arrays = [pa.array(np.full(len(some), i, np.int32)), pa.array(some), pa.array(total[some])]
            yield pa.RecordBatch.from_arrays(arrays, ["piece", "value", "n"])

    rows = prints.select("simhash").mapInArrow(count, "piece int, value long, n long")
    found = [np.zeros(1 << len(bits)) for bits in pieces]
    for piece, value, n in rows.groupBy("piece", "value").agg(F.sum("n").alias("n")).collect():
        found[piece][value] = n  # at most 2 ** SUB a sub-part
    return found


def _within(histogram: np.ndarray, tau: int) -> np.ndarray:
    """For each value, the number at each distance 0 to tau."""
    bits = len(histogram).bit_length() - 1
    values = np.arange(len(histogram))
    by_distance = np.zeros((tau + 1, len(histogram)))
    by_distance[0] = histogram
    for bit in range(bits):  # those with another value of this bit are one farther
        other = by_distance[:, values ^ (1 << bit)]
        by_distance[1:] += other[:-1]
    return by_distance


class Plan:
    """Parts of the bits, and what their thresholds cost a fingerprint by the estimates."""

    def __init__(self, parts: list[list[int]], histograms: dict, tau: int):
        self.parts, self.tau = parts, tau
        self.pieces = [_pieces(part) for part in parts]
        self.tables = [[_within(histograms[tuple(p)], tau) for p in pieces] for pieces in self.pieces]
        self.total = float(self.tables[0][0][0].sum())

    def costs(self, prints: np.ndarray) -> np.ndarray:
        """Work of each fingerprint by part and threshold: [part, threshold + 1, fingerprint].
        A part's sub-parts are taken as independent."""
        tau, n = self.tau, max(self.total, 1.0)
        out = np.zeros((len(self.parts), tau + 2, len(prints)))
        for i, (part, pieces, tables) in enumerate(zip(self.parts, self.pieces, self.tables)):
            at = None
            for bits, table in zip(pieces, tables):
                share = table[:, _values(prints, bits).astype(np.int64)] / n
                if at is None:
                    at = share
                else:
                    at = np.stack([sum(at[a] * share[d - a] for a in range(d + 1)) for d in range(tau + 1)])
            near = np.cumsum(at, axis=0) * n
            lookups = np.cumsum([math.comb(len(part), d) for d in range(tau + 1)])
            out[i, 1:] = LOOKUP * lookups[:, None] + VERIFY * near
        return out

    def thresholds(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least work of each fingerprint, and its thresholds [part, fingerprint]."""
        m, tau = len(self.parts), self.tau
        costs = self.costs(prints)
        total = tau + 1  # the thresholds plus one each add up to tau + 1
        best = np.full((total + 1, len(prints)), np.inf)
        best[0] = 0
        choice = np.zeros((m, total + 1, len(prints)), np.int8)
        for i in range(m):
            after = np.full_like(best, np.inf)
            for spent in range(total + 1):
                for use in range(min(spent, tau + 1) + 1):
                    way = best[spent - use] + costs[i, use]
                    less = way < after[spent]
                    after[spent][less] = way[less]
                    choice[i, spent][less] = use
            best = after
        left = np.full(len(prints), total)
        out = np.zeros((m, len(prints)), np.int8)
        for i in range(m - 1, -1, -1):
            use = choice[i, left, np.arange(len(prints))]
            out[i] = use - 1
            left = left - use
        return best[total], out


def plan_for(prints: DataFrame, tau: int = TAU) -> Plan:
    """The parts with the least estimated work over all fingerprints."""
    correlation = _correlation(prints)
    options = [parts_of(correlation, m) for m in range(2, tau + 2)]
    pieces = sorted({tuple(p) for parts in options for part in parts for p in _pieces(part)})
    histograms = dict(zip(pieces, _histograms(prints, [list(p) for p in pieces])))
    plans = [Plan(parts, histograms, tau) for parts in options]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = np.zeros(len(plans))
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            work += [plan.thresholds(values)[0].sum() for plan in plans]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(plans)), pa.int32()), pa.array(work)], ["plan", "work"])

    rows = prints.select("simhash").mapInArrow(weigh, "plan int, work double").groupBy("plan").agg(F.sum("work")).collect()
    return plans[min(rows, key=lambda r: (r[1], r[0]))[0]] if rows else plans[-1]


# Probe and verify


def _placed(prints: DataFrame, plan: Plan) -> DataFrame:
    """(part, value) of each fingerprint."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for i, part in enumerate(plan.parts):
                arrays = [pa.array(np.full(len(every), i, np.int32)), pa.array(_values(every, part).view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "value"])

    return prints.select("simhash").mapInArrow(place, "part int, value long")


def _looked_up(prints: DataFrame, plan: Plan) -> DataFrame:
    """(part, value, probe, simhash): where each fingerprint lies, and where it looks."""
    flips = [
        [
            np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(len(part)), distance)], np.uint64)
            for distance in range(plan.tau + 1)
        ]
        for part in plan.parts
    ]
    names = ["part", "value", "probe", "simhash"]

    def rows(part: int, values: np.ndarray, probe: bool, prints: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        arrays = [np.full(n, part, np.int32), values.view(np.int64), np.full(n, probe), prints.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            _, thresholds = plan.thresholds(every)
            for i, part in enumerate(plan.parts):
                values = _values(every, part)
                yield rows(i, values, False, every)
                for distance in range(plan.tau + 1):
                    some = thresholds[i] >= distance
                    if some.any():
                        masks = flips[i][distance]
                        for flip in np.array_split(masks, -(-len(masks) // FLIPS)):
                            looked = (values[some][:, None] ^ flip[None, :]).ravel()
                            yield rows(i, looked, True, np.repeat(every[some], len(flip)))

    return prints.select("simhash").mapInArrow(deal, "part int, value long, probe boolean, simhash long")


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of some links are enough to connect all that they do: by rounds, every tree
    hooks itself to the least tree that it has a link to."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(names))
    one, two = ends[: len(a)], ends[len(a) :]
    open_, keep = np.arange(len(a)), np.zeros(len(a), bool)
    while True:
        x, y = root[one[open_]], root[two[open_]]
        apart = x != y
        open_, x, y = open_[apart], x[apart], y[apart]
        if not len(open_):
            return keep
        high, low = np.maximum(x, y), np.minimum(x, y)
        order = np.lexsort((low, high))
        first = order[np.append(True, high[order][1:] != high[order][:-1])]
        root[high[first]] = low[first]
        keep[open_[first]] = True
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _met(here: np.ndarray, lookers: np.ndarray, begins: np.ndarray, sizes: np.ndarray, tau: int):
    """Links between what looks and what lies there: each looker meets the ``sizes`` entries of
    ``here`` from ``begins`` on, PAIRS at a time."""
    found_a, found_b = [], []
    edges = np.cumsum(sizes)
    at = 0
    while at < len(lookers):
        stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + PAIRS, side="right")))
        n = sizes[at:stop]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[at:stop], n)
        one, two = np.repeat(lookers[at:stop], n), here[place]
        near = (one < two) & (np.bitwise_count(one ^ two) <= tau)
        if near.any():
            a, b = one[near], two[near]
            some = _spanning(a, b)
            found_a.append(a[some])
            found_b.append(b[some])
        at = stop
    if not found_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    some = _spanning(a, b)
    return a[some], b[some]


def links(prints: DataFrame, plan: Plan) -> DataFrame:
    """(a, b): links between fingerprints (simhash, each once) that differ in at most tau bits,
    enough of them to connect all that are linked."""
    dealt = _looked_up(prints, plan)
    counts = _placed(prints, plan).groupBy("part", "value").count()
    common = stored(counts.filter(F.col("count") > BLOCK).select("part", "value", F.ceil(F.col("count") / BLOCK).alias("blocks")), "common")
    n = common.count()
    if n:
        side = F.broadcast(common) if 32 * n <= BROADCAST else common
        dealt = dealt.join(side, ["part", "value"], "left")
    else:
        dealt = dealt.withColumn("blocks", F.lit(None).cast("long"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    # a looker's block meets all blocks of what lies there
    own = F.pmod(F.xxhash64("simhash"), blocks)
    others = F.sequence(F.lit(0).cast("long"), blocks - 1)
    spread = dealt.select(
        "part", "value", "probe", "simhash", own.alias("own"), F.explode(F.when(blocks > 1, others).otherwise(F.array(own))).alias("other")
    )
    looker = F.when(F.col("probe"), F.col("own")).otherwise(F.col("other"))
    there = F.when(F.col("probe"), F.col("other")).otherwise(F.col("own"))
    spread = spread.select("part", "value", looker.alias("looker"), there.alias("there"), "probe", "simhash")
    keys = ["part", "value", "looker", "there"]
    grouped = spread.repartition(*keys).sortWithinPartitions(*keys, "probe")
    tau = plan.tau

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one key follow each other, those that lie there first."""
        last, here = None, np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys])
            probe = np.asarray(batch.column("probe"))
            value = batch.column("simhash").to_numpy().view(np.uint64)
            new = np.ones(len(value), bool)
            new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            goes_on = last is not None and bool((key[:, 0] == last).all())
            new[0] = not goes_on
            lies = value[~probe]
            if goes_on:
                every = np.concatenate([here, lies])
            else:
                here = here[:0]
                every = lies
            group = np.cumsum(new) - new[0]
            counts_ = np.bincount(group[~probe], minlength=group[-1] + 1)
            counts_[0] += len(here)
            ends = np.cumsum(counts_)
            of = group[probe]
            a, b = _met(every, value[probe], (ends - counts_)[of], counts_[of], tau)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
            here, last = every[ends[-1] - counts_[-1] :], key[:, -1]

    return grouped.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, tau: int = TAU) -> DataFrame:
    """doc_id, simhash (a long) and component_id, the smallest doc_id reachable by links, of
    every row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have the fingerprint zero and are linked like any other.
    Equal texts, also of repeated rows, are linked.  A null doc_id is never the smallest one; a
    component without any other has a null component_id.  An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(fingerprints(texts, width=width), "simhashes")
    prints = stored(rows.groupBy("simhash").agg(F.min("doc_id").alias("least")), "fingerprints")
    with many_rows(prints.sparkSession):
        edges = stored(links(prints, plan_for(prints, tau)), "links")
    linked = stored(components(edges), "components")
    named = prints.join(linked, F.col("simhash") == F.col("node"), "left").select(
        F.col("simhash").alias("print"), "least", F.coalesce("component", "simhash").alias("component")
    )
    least = named.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("component") == F.col("of")).select("print", "component_id")
    return rows.join(named, F.col("simhash") == F.col("print")).drop("print")
