"""Token counts with a whole-token shortcut.

Most pre-tokens are vocabulary strings that encode alone as one token.  Which strings
do is proved before the job by encoding every word-final entry of the vocabulary with
the tokenizer itself; a task then counts a matching pre-token as one without a merge.
Only the rest is merged, once per distinct pre-token of a task while it is remembered.

Texts with characters outside the Latin alphabet of ``common``, or with a special
token's string in them, are encoded whole by the tokenizer, so the count is always its own.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.llm.common import (
    LATIN_LETTERS,
    LATIN_NUMBERS,
    LATIN_SPACES,
    OUTSIDE_LATIN,
    paragraphs,
    small_batches,
)

PRETOKENS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]"
    f"|[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)

#: Characters split at once, and merged pre-tokens remembered by a task.
PIECE, REMEMBERED = 1 << 18, 1 << 18


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable,
    else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(path: str) -> frozenset[str]:
    """The lower-case pre-tokens that the tokenizer proves to be one token each."""
    tokenizer = _tokenizer(path)
    found, letters = set(), _byte_letters()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if entry.endswith("</w>"):
            text = bytes(letters[c] for c in entry[:-4]).decode("utf-8", "ignore")
            if text == text.lower() and not OUTSIDE_LATIN.search(text) and PRETOKENS.fullmatch(text):
                found.add(text)
    candidates = sorted(found)
    return frozenset(t for t, n in zip(candidates, _lengths(tokenizer, candidates)) if n == 1)


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


class Counter:
    """Counts the tokens of texts; ``whole`` are the pre-tokens known to be one token.

    A task has a core of its own: threads of the library would only wait for each other.
    """

    def __init__(self, path: str, whole: frozenset[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.whole, self.merged = _tokenizer(path), whole, {}
        self.special = special_strings(path)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if OUTSIDE_LATIN.search(text) or any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(self._count(piece) for piece in paragraphs(text, PIECE))

    def _count(self, text: str) -> int:
        pretokens = PRETOKENS.findall(text.lower())
        rest = [t for t in pretokens if t not in self.whole]
        missing = list({t for t in rest if t not in self.merged})
        if len(self.merged) + len(missing) > REMEMBERED:
            self.merged, missing = {}, list(set(rest))
        self.merged.update(zip(missing, _lengths(self.tokenizer, missing)))
        return len(pretokens) - len(rest) + sum(map(self.merged.__getitem__, rest))


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """The number of tokens of a text column, without special tokens; 0 for null or empty."""
    small_batches(spark)
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # no more than the vocabulary

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path, whole.value)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, whatever other columns there are.

    A null text counts as empty: no bytes, no tokens.  Repeated rows each give a row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, text, path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
