"""Near-duplicate texts by an exact join on word n-grams.

Texts with equal sets of shingles are one class.  An inverted index of all classes counts
how many have each shingle, and gives back to a class the shingles that others have too;
a class that shares too few of them can have no partner.  Those left order their shingles
rarest first.  Two sets that are alike enough share one of their first few shingles, the
prefix; classes meet there if their sizes and places allow the overlap (length and
positional filter), then if the spread of their shingles over 64 ranges does (suffix
filter), and each pair is verified once on the full sets.

Large groups of near copies are not written out pair by pair.  The members of a prefix
group are first compared with a leader and with their neighbour in size.  Classes that
resemble each other at least loosely make a cluster; a cluster whose links leave it in
several components is compared within tasks, block by block, and only pairs of different
components are.  The pairs left, between different clusters, are all joined.  So every
pair of two components is either compared or ruled out by a filter that loses none.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamsync.llm.common import free_name, give_back, small_batches, stored
from streamsync.llm.components import components
from streamsync.llm.shingles import set_names, shingle_sets

#: Words of a shingle; similarity in percent that links two texts.
WIDTH, PERCENT = 5, 80
#: Shingles that a task of the index holds at once, about.
POSTINGS = 1 << 22
#: Least number of ranges of the index; similarity in percent within a cluster.
RANGES, LOOSE = 16, 40
#: Bits by which a task parts what it holds, to sort one part after the other.
PART_BITS = 4
#: Classes of a cluster that a task compares with as many others.
BLOCK = 1024
#: Members of a prefix group that one task compares with one leader, or with as many others.
SALTED = 2048


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(column).to_pylist()]


def _signed(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def sets(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows with n_shingles and set_id added; equal sets have equal ids."""
    small_batches(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name != text]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bounds = shingle_sets(_texts(batch, text), width)
            arrays = [batch.column(f.name) for f in others]
            arrays += [pa.array(np.diff(bounds)), _signed(set_names(hashes, bounds))]
            yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in others), "n_shingles", "set_id"])
        give_back()

    schema = docs.drop(text).schema.add("n_shingles", "long").add("set_id", "long")
    return docs.mapInArrow(hashed, schema)


# A block of postings travels as byte planes, which sorted numbers leave easy to compress.


def _pack(*arrays: np.ndarray) -> bytes:
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(data: bytes, n: int, *types: str) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    for kind in map(np.dtype, types):
        size = kind.itemsize * n
        plane = np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += size
    return out


_BLOCK = pa.schema([("target", pa.int32()), ("n", pa.int64()), ("classes", pa.binary()), ("postings", pa.binary())])
_BLOCK_DDL = "target int, n long, classes binary, postings binary"
_CLASS = np.dtype([("id", "<u8"), ("size", "<u4")])


def _parts(hashes: np.ndarray, from_bit: int, bits: int = PART_BITS) -> Iterator[np.ndarray]:
    """Where the hashes are that have each value of the ``bits`` bits after the first
    ``from_bit``, by rising value."""
    part = hashes >> np.uint64(64 - from_bit - bits)
    part &= np.uint64((1 << bits) - 1)
    part = part.astype(np.uint8)
    for value in range(1 << bits):
        yield np.flatnonzero(part == value)


def _block(target: int, classes: np.ndarray, of: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """A block of postings: their hashes, classes and more, with only the classes they have."""
    used, local = np.unique(of, return_inverse=True)
    table = zstandard.ZstdCompressor(level=1).compress(classes[used].tobytes())
    postings = _pack(columns[0], local.astype(np.uint32), *columns[1:])
    row = {"target": target, "n": len(of), "classes": table, "postings": postings}
    return pa.RecordBatch.from_pylist([row], _BLOCK)


def _blocks(held: list, bits: int) -> Iterator[pa.RecordBatch]:
    """The blocks of a list of (shingles, names, sizes) of sets, which is empty then."""
    names = np.concatenate([n for _, n, _ in held])
    sizes = np.concatenate([s for _, _, s in held])
    _, first = np.unique(names, return_index=True)
    keep = np.zeros(len(names), bool)
    keep[first] = True
    keep &= sizes > 0
    classes = np.empty(int(keep.sum()), _CLASS)
    classes["id"], classes["size"] = names[keep], sizes[keep]
    total = int(sizes[keep].sum())
    hashes, of = np.empty(total, np.uint64), np.repeat(np.arange(len(classes), dtype=np.uint32), sizes[keep])
    at = nth = 0
    held.reverse()
    while held:
        found, _, lengths = held.pop()
        found = found[np.repeat(keep[nth : nth + len(lengths)], lengths)]
        hashes[at : at + len(found)] = found
        at, nth = at + len(found), nth + len(lengths)
    top = min(bits, PART_BITS)
    for part, some in enumerate(_parts(hashes, 0, top)):
        some = some[np.argsort(hashes[some])]
        here, owner = hashes[some], of[some]
        targets = np.arange(part << (bits - top), ((part + 1) << (bits - top)) + 1)
        edges = np.searchsorted(here >> np.uint64(64 - bits), targets)
        for target, a, b in zip(targets.tolist(), edges, edges[1:]):
            if a < b:
                yield _block(target, classes, owner[a:b], here[a:b])


def _index(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """Blocks of (shingle, class) by range of shingles, each with the classes that it has; a
    class is there once for all texts of a block."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            hashes, bounds = shingle_sets(_texts(batch, "text"), width)
            held.append((hashes, set_names(hashes, bounds), np.diff(bounds)))
            n += len(hashes)
            if n >= POSTINGS:
                yield from _blocks(held, bits)
                n = 0
        if n:
            yield from _blocks(held, bits)
        give_back()

    return docs.select("text").mapInArrow(post, _BLOCK_DDL)


def _read_blocks(batches: Iterator[pa.RecordBatch], *types: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """All classes of a group's blocks, and its postings with numbers of classes."""
    batches = [batch.select(["n", "classes", "postings"]) for batch in batches]
    total = sum(pc.sum(batch.column("n")).as_py() or 0 for batch in batches)
    every, tables, at, known = [np.empty(total, t) for t in types], [], 0, 0
    for batch in batches:
        for n, table, postings in zip(*batch.columns):
            table = np.frombuffer(zstandard.ZstdDecompressor().decompress(table.as_buffer()), _CLASS)
            found = _unpack(postings.as_buffer(), n.as_py(), *types)
            found[1] = found[1] + np.uint32(known)
            for column, some in zip(every, found):
                column[at : at + len(some)] = some
            tables.append(table)
            at, known = at + len(found[0]), known + len(table)
    table = np.concatenate(tables)
    _, first, number = np.unique(table["id"], return_index=True, return_inverse=True)
    every[1] = number.astype(np.uint32)[every[1]]
    return table[first], every


def _several(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different postings of shingles with several classes, by shingle and class, and how
    many classes each shingle has."""
    order = np.argsort(hashes)
    hashes, of = hashes[order], of[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
    times = np.diff(np.append(starts, len(hashes)))
    several = np.repeat(times > 1, times)
    hashes, of = hashes[several], of[several]
    order = np.lexsort((of, hashes))
    hashes, of = hashes[order], of[order]
    once = np.ones(len(hashes), bool)  # a class may be in several blocks
    once[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[once], of[once]
    new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    times = np.diff(np.append(np.flatnonzero(new), len(hashes)))
    df = np.repeat(times, times).astype(np.uint32)
    return hashes[df > 1], of[df > 1], df[df > 1]


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Of one range's blocks: the postings of shingles with several classes, in blocks by
    range of classes."""
    classes, (hashes, of) = _read_blocks(batches, "<u8", "<u4")
    found = [_several(hashes[some], of[some]) for some in _parts(hashes, bits)]
    del hashes, of
    hashes, of, df = (np.concatenate(column) for column in zip(*found))
    del found
    to = (classes["id"] >> np.uint64(64 - bits)).astype(np.int32)[of]
    order = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[order], np.arange((1 << bits) + 1))
    del to
    for target, (a, b) in enumerate(zip(edges, edges[1:])):
        if a < b:
            here = order[a:b]
            yield _block(target, classes, of[here], hashes[here], df[here])


def _shared(index: DataFrame, bits: int) -> DataFrame:
    """Blocks of (shingle, class, number of classes) of shingles with several classes,
    by range of classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(batches, bits)
        give_back()

    return index.groupBy("target").applyInArrow(count, _BLOCK_DDL)


_SET = pa.schema(
    [
        ("set_id", pa.int64()), ("n", pa.int64()), ("shared", pa.binary()), ("spread", pa.binary()),
        ("prefix", pa.list_(pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("classes", pa.int64())]))),
    ]
)


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection with any set that is alike enough."""
    return -(-n * percent // 100)


def _candidates(blocks: DataFrame, percent: int) -> DataFrame:
    """Classes that share enough: set_id, n, their shared shingles rarest first (binary), how
    many of these lie in each of 64 ranges, and the shared part of the prefix.

    Shingles that no other class has come first in every set and need no room.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, (hashes, of, df) = _read_blocks(batches, "<u8", "<u4", "<u4")
        count = np.bincount(of, minlength=len(classes))
        sizes = classes["size"].astype(np.int64)
        keep = count >= np.maximum(1, _least_overlap(sizes, percent))
        some = keep[of]
        hashes, of, df = hashes[some], of[some], df[some]
        del some
        order = np.lexsort((hashes, df, of))
        hashes, of, df = hashes[order], of[order], df[order]
        del order
        rows = []
        bounds = np.searchsorted(of, np.arange(len(classes) + 1))
        for c in np.flatnonzero(keep):
            a, b = bounds[c], bounds[c + 1]
            n, own = int(sizes[c]), int(sizes[c] - (b - a))
            prefix = n - int(_least_overlap(np.int64(n), percent)) + 1 - own
            spread = np.minimum(np.bincount(hashes[a:b] >> np.uint64(58), minlength=64), 65535)
            rows.append(
                {
                    "set_id": int(classes["id"][c].view(np.int64)),
                    "n": n,
                    "shared": hashes[a:b].tobytes(),
                    "spread": spread.astype("<u2").tobytes(),
                    "prefix": [
                        {"shingle": h, "place": own + i, "classes": d}
                        for i, (h, d) in enumerate(zip(hashes[a : a + prefix].view(np.int64).tolist(), df[a : a + prefix].tolist()))
                    ],
                }
            )
            if len(rows) == 512:
                yield pa.RecordBatch.from_pylist(rows, _SET)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SET)
        del hashes, of, df, rows
        give_back()

    schema = (
        "set_id long, n long, shared binary, spread binary, "
        "prefix array<struct<shingle: long, place: int, classes: long>>"
    )
    return blocks.groupBy("target").applyInArrow(gather, schema)


def _may_match(n: Column, place: Column, m: Column, other: Column, percent: int) -> Column:
    """Length and positional filter for two sets with a shingle at these places: what is
    left of both from there on must hold the overlap that the likeness needs."""
    most = F.least(place, other) + F.least(n - place, m - other)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _verified(pairs: DataFrame, found: DataFrame, percent: int, least: int) -> DataFrame:
    """The pairs (a, b) of set ids that are alike to ``least`` percent, and whether they
    are to ``percent``.  First the suffix filter: of each range of shingles two sets share
    no more than the smaller number."""
    light = found.select("set_id", "n", "spread")
    of_a = light.toDF("a_id", "a_n", "a_spread")
    of_b = light.toDF("b_id", "b_n", "b_spread")
    both = pairs.join(of_a, F.col("a") == F.col("a_id")).join(of_b, F.col("b") == F.col("b_id"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, 64)
                for c in ("a_spread", "b_spread")
            )
            sizes = np.asarray(batch.column("a_n")) + np.asarray(batch.column("b_n"))
            most = np.minimum(one, two).sum(axis=1, dtype=np.int64)
            full = (one == 65535).any(axis=1) | (two == 65535).any(axis=1)
            keep = full | ((100 + least) * most >= least * sizes)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
        give_back()

    likely = both.select("a", "b", "a_n", "b_n", "a_spread", "b_spread").mapInArrow(near, "a long, b long")
    likely = stored(likely, "likely-pairs")  # one Python worker a task, not two
    whole = found.select("set_id", "n", "shared")
    of_a, of_b = whole.toDF("a_id", "a_n", "a_shared"), whole.toDF("b_id", "b_n", "b_shared")
    both = likely.join(of_a, F.col("a") == F.col("a_id")).join(of_b, F.col("b") == F.col("b_id"))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, link = [], []
            columns = [batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_shared", "b_shared")]
            for n, m, one, two in zip(*columns):
                every = np.sort(np.concatenate([np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8")]))
                common = int((every[1:] == every[:-1]).sum())
                keep.append(100 * common >= least * (n + m - common))
                link.append(100 * common >= percent * (n + m - common))
            pairs = [batch.column("a"), batch.column("b"), pa.array(link, pa.bool_())]
            every = pa.RecordBatch.from_arrays(pairs, ["a", "b", "link"])
            yield every.filter(pa.array(keep, pa.bool_()))
        give_back()

    wide = both.select("a", "b", "a_n", "b_n", "a_shared", "b_shared")
    return wide.mapInArrow(alike, "a long, b long, link boolean")


def _members(found: DataFrame, linked: DataFrame | None) -> DataFrame:
    """set_id, n, shingle, place, classes, component of each prefix shingle."""
    rows = found.select("set_id", "n", F.explode("prefix").alias("p")).select("set_id", "n", "p.*")
    if linked is None:
        return rows.withColumn("component", F.col("set_id"))
    named = linked.select(F.col("node"), F.col("component").alias("linked"))
    rows = rows.join(named, F.col("set_id") == F.col("node"), "left")
    return rows.withColumn("component", F.coalesce("linked", "set_id")).drop("node", "linked")


def _proposed(members: DataFrame, percent: int) -> DataFrame:
    """For each class the leader and the neighbour in size that it meets most often."""
    part = F.pmod(F.xxhash64("set_id"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("classes") / SALTED)))
    group = Window.partitionBy("shingle", "part").orderBy("n", "set_id")
    other = F.struct("set_id", "n", "place")
    met = members.withColumn("part", part).select(
        "set_id", "n", "place", F.first(other).over(group).alias("leader"), F.lag(other).over(group).alias("next")
    )
    each = met.select(
        "set_id", "n", "place",
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("leader").alias("o")), F.struct(F.lit(1).alias("kind"), F.col("next").alias("o")))).alias("x"),
    ).select("set_id", "n", "place", "x.kind", F.col("x.o.set_id").alias("other"), F.col("x.o.n").alias("m"), F.col("x.o.place").alias("at"))
    each = each.filter(
        F.col("other").isNotNull() & (F.col("other") != F.col("set_id"))
        & _may_match(F.col("n"), F.col("place"), F.col("m"), F.col("at"), percent)
    )
    counted = each.groupBy("set_id", "kind", "other").agg(F.count("*").alias("times"))
    best = counted.groupBy("set_id", "kind").agg(F.max_by("other", F.struct("times", "other")).alias("other"))
    return best.select(F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b")).distinct()


def _within(found: DataFrame, clusters: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of a cluster, enough of them to join all
    that are linked.  A cluster's classes are dealt into blocks of about BLOCK; each pair
    of blocks is a task's."""
    own = clusters.select(F.col("node").alias("set_id"), F.col("component").alias("cluster"))
    named = linked.select("node", F.col("component").alias("linked"))
    own = own.join(named, F.col("set_id") == F.col("node"), "left")
    own = own.select("set_id", "cluster", F.coalesce("linked", "set_id").alias("component"))
    sizes = own.groupBy(F.col("cluster").alias("c")).agg(
        F.count("*").alias("size"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    blocks = F.ceil(F.col("size") / BLOCK)
    open_ = own.join(sizes.filter("least <> most"), F.col("cluster") == F.col("c")).select(
        "set_id", "cluster", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("set_id"), blocks).alias("block")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = open_.select("set_id", "cluster", "component", "block", other)
    sets_ = found.select(F.col("set_id").alias("id"), "n", "shared")
    dealt = dealt.join(sets_, F.col("set_id") == F.col("id")).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "set_id", "component", "n", "shared",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        block, low, high = (rows.column(c).to_numpy() for c in ("block", "low", "high"))
        ids, of, n = (rows.column(c).to_numpy() for c in ("set_id", "component", "n"))
        shared = [np.frombuffer(x.as_buffer(), "<u8") for x in rows.column("shared")]
        sides = [np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])]
        names, number = np.unique(of, return_inverse=True)
        giant = np.bincount(number).argmax()
        parent = list(range(len(names)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found_a, found_b = [], []
        for mine, theirs in (sides, sides[::-1])[: 1 if low[0] == high[0] else 2]:
            minor = mine[number[mine] != giant]
            if not len(minor) or not len(theirs):
                continue
            every = np.concatenate([shared[i] for i in theirs])
            owner = np.repeat(np.arange(len(theirs)), [len(shared[i]) for i in theirs])
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            for i in minor:
                begins = np.searchsorted(every, shared[i])
                sizes = np.searchsorted(every, shared[i], side="right") - begins
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                common = np.bincount(owner[np.repeat(begins, sizes) + place], minlength=len(theirs))
                alike = 100 * common >= percent * (n[i] + n[theirs] - common)
                for j in theirs[alike & (number[theirs] != number[i])]:
                    a, b = root(number[i]), root(number[j])
                    if a != b:
                        parent[a] = b
                        found_a.append(ids[i])
                        found_b.append(ids[j])
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return dealt.groupBy("cluster", "low", "high").applyInArrow(compare, "a long, b long")


def _rest(members: DataFrame, percent: int) -> DataFrame:
    """Every pair of classes of different clusters that meet in their prefixes.

    The classes of a shingle are dealt into blocks of about SALTED, and each pair of blocks
    is a join key of its own, so that no task has all pairs of a shingle."""
    mixed = members.groupBy(F.col("shingle").alias("s")).agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size")
    )
    blocks = F.ceil(F.col("size") / SALTED)
    open_ = members.join(mixed.filter("least <> most"), F.col("shingle") == F.col("s")).select(
        "shingle", "set_id", "n", "place", "component", F.pmod(F.xxhash64("set_id"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"),
    )
    names = ["shingle", "set_id", "n", "place", "component"]
    one = open_.filter("block <= other").select(*names, F.col("block").alias("low"), F.col("other").alias("high"))
    two = open_.filter("block >= other").select(*names, F.col("other").alias("low"), F.col("block").alias("high"))
    two = two.toDF("o_shingle", "o_id", "m", "at", "o_component", "o_low", "o_high")
    once = (F.col("low") < F.col("high")) | (F.col("set_id") < F.col("o_id"))
    same = (F.col("shingle") == F.col("o_shingle")) & (F.col("low") == F.col("o_low")) & (F.col("high") == F.col("o_high"))
    met = one.join(two, same & once).filter(
        (F.col("component") != F.col("o_component"))
        & _may_match(F.col("n"), F.col("place"), F.col("m"), F.col("at"), percent)
    )
    return met.select(F.least("set_id", "o_id").alias("a"), F.greatest("set_id", "o_id").alias("b")).distinct()


def links(docs: DataFrame, shingles: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """node, component of the classes of equal sets that are linked with another class.

    ``docs`` has text; ``shingles`` is the number of shingles of all texts, by which the
    index is dealt out."""
    bits = max(RANGES - 1, -(-shingles // POSTINGS) - 1).bit_length()
    blocks = _shared(_index(docs, width, bits), bits)
    found = stored(_candidates(blocks, percent), "shared-shingles")
    pairs = _proposed(_members(found, None), percent)
    near = stored(_verified(pairs, found, percent, min(LOOSE, percent)), "near-pairs")
    edges = near.filter("link").select("a", "b")
    clusters = stored(components(near.select("a", "b")), "clusters")
    linked = stored(components(edges), "components")
    inside = stored(_within(found, clusters, linked, percent), "links-within")
    rest = _rest(_members(found, clusters), percent)
    between = stored(_verified(rest, found, percent, percent).select("a", "b"), "links-between")
    return stored(components(edges.union(inside).union(between)), "components")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Null, empty or wordless texts have no shingles and are linked with nothing: each is
    its own component.  Fewer words than ``width`` are one shingle.  Equal texts, also of
    repeated rows, are linked; a null doc_id is never a component's smallest one, and a
    component without any other has a null component_id.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(sets(texts, width=width), "shingle-sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    classes = rows.filter("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    linked = links(texts.select("text"), total, width, percent)
    named = classes.join(linked, F.col("set_id") == F.col("node"), "left").select(
        F.col("set_id").alias("class"), "least", F.coalesce("component", "set_id").alias("component")
    )
    named = stored(named, "classes")
    least = named.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("component") == F.col("of")).select("class", "component_id")
    joined = rows.join(named, (F.col("set_id") == F.col("class")) & (F.col("n_shingles") > 0), "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", alone).alias("component_id"))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all columns as they were.

    Rows without shingles all stay, and so do rows without a doc_id.  Of several rows of
    one doc_id that have shingles, the one with the smallest text stays.
    """
    name, rank = free_name(docs, "component"), free_name(docs, "nth")
    found = near_duplicates(docs, width, percent).filter("n_shingles > 0 and doc_id is not null")
    found = stored(found, "near-duplicates")
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
    several = found.groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias(rank)).filter(F.col(rank) > 1)
    several = stored(several.select(name), "repeated-ids")
    if several.isEmpty():
        return kept
    same = F.col("doc_id") == F.col(name)
    order = Window.partitionBy("doc_id").orderBy(F.desc(F.col("text").rlike(_WORD)), "text")
    first = kept.join(several, same, "left_semi").withColumn(rank, F.row_number().over(order))
    first = first.filter((F.col(rank) == 1) | ~F.coalesce(F.col("text").rlike(_WORD), F.lit(False)))
    return kept.join(several, same, "left_anti").union(first.drop(rank))


_WORD = r"[^\x20\x09-\x0D]"
