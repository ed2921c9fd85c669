"""Best-fit packing of documents into sequences under several capacities at once.

A document's token ids are cut into pieces of at most a sequence's length; all but the
first are full.  A full piece is a sequence by itself.  The others are dealt at random
to groups of bounded size, and each group is packed by vector best fit: pieces go by
falling length into the open sequence that has room for their tokens, one more document
and their attention cost (length squared), and is best by rule

- ``norm``: the least weighted norm of the relative capacities left after placing, or
- ``dot``: the largest weighted dot product of the piece's and the sequence's relative
  loads, which puts a piece where the same resources are used.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.llm.common import OUTSIDE_LATIN, give_back, small_batches, stored

#: Pieces of one group; a group leaves a few sequences partly empty.
GROUP_PIECES = 8192


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds.  Without limits of their own, documents and attention cost
    cannot exceed what the tokens allow.  The weights are those of tokens, documents and
    attention cost in the choice of a sequence."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)

    def __post_init__(self):
        if min(self.limits()) < 1 or self.rule not in ("norm", "dot"):
            raise ValueError("capacities are positive, the rule is norm or dot")

    def limits(self) -> tuple[int, int, int]:
        square = self.tokens * self.tokens
        return (
            self.tokens,
            self.tokens if self.documents is None else self.documents,
            square if self.attention is None else self.attention,
        )

    @property
    def piece(self) -> int:
        """The longest piece that a sequence can hold."""
        return min(self.tokens, math.isqrt(self.limits()[2]))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) of each piece and its place there."""
    limits = np.array(capacity.limits(), dtype=np.float64)
    weights = np.array(capacity.weights)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room = np.empty((3, len(lengths) + 1))
    names, used, opened = np.empty(len(lengths) + 1, np.int64), 0, 0
    shortest = lengths.min(initial=capacity.tokens)
    for i in np.argsort(-lengths, kind="stable"):
        n = float(lengths[i])
        demand = np.array([n, 1.0, n * n])
        left = (room[:, :used] - demand[:, None]) / limits[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            if capacity.rule == "norm":
                score = weights @ np.square(left[:, fits])
            else:
                load = 1 - room[:, :used][:, fits] / limits[:, None]
                score = -(weights * demand / limits) @ load
            at = fits[np.argmin(score)]
        else:
            at = used
            room[:, at], names[at] = limits, opened
            used, opened = used + 1, opened + 1
        bins[i], offsets[i] = names[at], limits[0] - room[0, at]
        room[:, at] -= demand
        if room[0, at] < shortest or room[1, at] < 1:  # full: the last open one takes its place
            used -= 1
            room[:, at], names[at] = room[:, used], names[used]
    return bins, offsets


def packed(pieces: DataFrame, capacity: Capacity) -> DataFrame:
    """The pieces with sequence_id (even) and offset; needs a column ``length`` of at most
    ``capacity.piece`` and the name ``group`` free.  Lengths below 1 take part as they are."""
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit(rows["length"].to_numpy(np.int64), capacity)
        rows = rows.drop(columns="group")
        return rows.assign(sequence_id=((int(key[0]) << 32) + bins) * 2, offset=offsets)

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(pack, schema)


#: The byte-level vocabulary's own rule for pre-tokens, as the tokenizer has it.
PRETOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoder(path: str):
    """ids of a text as the tokenizers library gives them for the vocabulary file.

    Latin text without a special token's string goes through the same merges in a faster
    library; the tests hold the two against each other.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        setup = json.load(file)
    own: list[Tokenizer] = []

    def slow(text: str) -> list[int]:
        if not own:  # most tasks never need it
            own.append(Tokenizer.from_file(path))
        return own[0].encode(text, add_special_tokens=False).ids

    pre = setup.get("pre_tokenizer") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre["add_prefix_space"]
    if not byte_level or setup.get("normalizer") or setup["model"].get("type") != "BPE":
        return slow
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in setup["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in setup["model"]["vocab"].items()
        if token not in special
    }
    merges = [m if isinstance(m, str) else " ".join(m) for m in setup["model"]["merges"]]
    ordered = [bytes(letters[c] for c in m.replace(" ", "")) for m in merges]
    if any(ranks[a] >= ranks[b] for a, b in zip(ordered, ordered[1:])):
        return slow  # ids don't rise with the merges
    fast = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
    odd = re.compile("|".join([OUTSIDE_LATIN.pattern, *map(re.escape, special)]))
    return lambda text: slow(text) if odd.search(text) else fast.encode_ordinary(text)


def cut(spark: SparkSession, text: Column, path: str, end: int, longest: int) -> Column:
    """The pieces of a text as an array of structs (start, length, ids_crc32)."""
    small_batches(spark)

    @F.pandas_udf("array<struct<start: long, length: long, ids_crc32: long>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _cut_batches(batches, path, end, longest)

    return pieces(text)


def _cut_batches(batches: Iterator[pd.Series], path: str, end: int, longest: int) -> Iterator[pd.Series]:
    """The pieces of a task's texts; a worker that waits for its next task keeps no vocabulary."""
    encode = _encoder(path)
    for texts in batches:
        yield pd.Series([_pieces(encode(t) if t else [], end, longest) for t in texts])
    del encode
    _encoder.cache_clear()
    give_back()


def _pieces(ids: list[int], end: int, longest: int) -> list[dict]:
    code = np.array([*ids, end], dtype="<u4")
    first = len(code) % longest or longest
    edges = [0, *range(first, len(code) + 1, longest)]
    return [
        {"start": a, "length": b - a, "ids_crc32": zlib.crc32(code[a:b].tobytes())}
        for a, b in zip(edges, edges[1:])
    ]


def pack_documents(
    docs: DataFrame, path: str, capacity: Capacity = Capacity(), end: int = 2
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A null or empty text is the end id alone.  Repeated rows, also of the same doc_id,
    are packed each for itself, told apart by ``row``.  Other columns are not looked at.
    """
    longest = capacity.piece
    cuts = docs.select(
        "doc_id", cut(docs.sparkSession, F.col("text"), path, end, longest).alias("cuts")
    )
    pieces = stored(
        cuts.withColumn("row", F.monotonically_increasing_id()).select(
            "doc_id", "row", F.posexplode("cuts").alias("piece", "cut")
        ).select("doc_id", "row", "piece", "cut.*"),
        "pieces",
    )
    # a piece as long as a sequence leaves no room: odd numbers are theirs
    full = pieces.filter(F.col("length") == capacity.tokens)
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn(
        "offset", F.lit(0).cast("long")
    )
    return packed(pieces.filter(F.col("length") < capacity.tokens), capacity).unionByName(alone)
