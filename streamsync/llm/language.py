"""Language identification in two steps: the family first, then the language within it.

A text is its distribution of hashed runs of one to three letters.  Linear support vector
machines tell each family from the rest; within the likeliest family, one machine for
each pair of its languages votes.  The machines learn from all labelled rows, group by
group; texts are read whole in learning and in prediction.
"""

from __future__ import annotations

import itertools
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.llm.common import free_name, give_back, remainder, small_batches
from streamsync.llm.linear import train_svm

#: Languages of one family are told apart by machines of their own; any other language
#: value is a family by itself.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ca ro gl oc",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn ur mr gu pa ne si",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Sizes of the hashed features, of a language's part of a group of rows, and of a group.
WIDTH, PER_LANGUAGE, GROUP_ROWS = 4096, 400, 4096
#: Machines added up at once, copies remembered by a task, and steps of a counted score.
ADDED, REMEMBERED, STEPS = 64, 1 << 18, 1 << 16
#: A group's machine between ``one`` and ``other``: weights and bias, of so many groups.
MACHINES = "one string, other string, group long, machine binary, times long"
UNKNOWN = "und"
#: The score below which a text is in no learned language (the lowest of 2,495 right
#: predictions of held-out rows was 0.674), lowered to BELOW under that of the lowest
#: thousandth of the right predictions where these are lower.
LEAST, BELOW = 0.65, 0.02

#: Letters up to U+024F; what lies above counts as a letter, anything else as a space.
_LETTER = np.array([chr(c).isalpha() for c in range(0x250)])
_SLICE = 1 << 20


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed runs of 1 to 3 characters, words apart."""
    counts = np.zeros(WIDTH)
    for begin in range(0, len(text), _SLICE):
        part = text[max(0, begin - 2) : begin + _SLICE].lower().encode("utf-32-le", "surrogatepass")
        code = np.frombuffer(part, dtype="<u4")
        code = np.where(_LETTER[np.minimum(code, 0x24F)] | (code > 0x24F), code, 0).astype(np.uint32)
        run, last = np.zeros(len(code), np.uint32), np.ones(len(code), bool)
        for n in range(min(3, len(code))):
            run = (run[n > 0 :] if n else run) * np.uint32(0x01000193) + (code[n:] + np.uint32(7)) * np.uint32(0x9E3779B1)
            last = code[n:] > 0 if n == 0 else last[1:] | (code[n:] > 0)
            mixed = (run ^ (run >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            counts += np.bincount((mixed >> np.uint32(20))[last], minlength=WIDTH)
    return np.sqrt(counts / max(1.0, counts.sum()))


def machines(languages: list[str], rows: np.ndarray, only: bool = True) -> dict:
    """Weights and bias of each family, ``(family, "")``, and of each pair of languages of a
    family.  A family without any other row has no machine unless it is the ``only`` one."""
    used = np.flatnonzero(rows.any(axis=0))  # other weights are zero
    rows, known = rows[:, used], np.array(languages)
    family = np.array([FAMILY_OF.get(x.lower(), x) for x in languages])
    aims = {(f, ""): (slice(None), family == f) for f in sorted(set(family.tolist()))}
    for f in list(aims):
        members = sorted(set(known[aims[f][1]].tolist()))
        for a, b in itertools.combinations(members, 2):
            both = (known == a) | (known == b)
            aims[a, b] = both, known[both] == a
    found = {}
    for name, (some, labels) in aims.items():
        if only or not labels.all():
            weights, bias = train_svm(rows[some], labels)
            whole = np.zeros(WIDTH)
            whole[used] = weights
            found[name] = whole, bias
    return found


class Model:
    """The machines of families and of pairs of languages within a family."""

    def __init__(self, languages: list[str], found: dict):
        self.members = {}
        for name in sorted(languages):
            self.members.setdefault(FAMILY_OF.get(name.lower(), name), []).append(name)
        self.members = dict(sorted(self.members.items()))
        self.families = list(self.members)
        found = {key: (weights.astype("<f4"), bias) for key, (weights, bias) in found.items()}
        none = np.zeros(WIDTH, "<f4"), 0.0  # families that no group of rows held with others
        each = [found.get((f, ""), none) for f in self.families]
        self.family = np.stack([w for w, _ in each]) if each else np.zeros((0, WIDTH))
        self.family_bias = np.array([b for _, b in each])
        self.pairs = {
            pair: found.get(pair, none) for f in self.families for pair in itertools.combinations(self.members[f], 2)
        }

    def predict(self, row: np.ndarray) -> tuple[str, float]:
        """The likeliest language and a score from 0 to 1; ties go to the first name."""
        if not self.families:
            return UNKNOWN, 0.0
        margins = self.family @ row + self.family_bias
        chance = np.exp(2 * (margins - margins.max()))
        chance /= chance.sum()
        at = int(np.argmax(chance))
        names = self.members[self.families[at]]
        votes = dict.fromkeys(names, 0.0)
        for a, b in itertools.combinations(names, 2):
            weights, bias = self.pairs[a, b]
            first = 1 / (1 + np.exp(-2 * float(np.clip(weights @ row + bias, -15, 15))))
            votes[a] += (first > 0.5) + first / len(names)
            votes[b] += (first <= 0.5) + (1 - first) / len(names)
        best = max(names, key=lambda x: votes[x])
        most = (len(names) - 1) * (1 + 1 / len(names))
        return best, float(chance[at] * (votes[best] / most if most else 1.0))


def dealt(usable: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[DataFrame, list[str]]:
    """Every different row's features in groups of bounded size, and the values of lang.

    A group has about ``per_language`` rows for each value, GROUP_ROWS at most.  A rare value's
    rows are in several groups, so that each group has some; together at most twice the rows.
    """
    rows = usable.select("lang", "text", F.xxhash64("lang", "text").alias("hashed"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("hashed", 0.02).alias("n"))
    counts = {r.lang: r.n for r in counted.collect()}
    size = max(1, min(GROUP_ROWS, per_language * len(counts)))
    groups = max(1, -(-sum(counts.values()) // size))
    least = max(1, size // (2 * max(1, len(counts))))
    chunks = {name: max(1, min(groups, n // least)) for name, n in counts.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies that one task has passed on; a group drops the others
        for batch in batches:
            found = []
            for name, text, hashed in zip(batch["lang"], batch["text"], batch["hashed"]):
                if hashed not in seen:
                    seen.add(hashed)
                    row = features(text)
                    at = np.flatnonzero(row)
                    row = at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes()
                    found += [(g, hashed, name, row) for g in range(hashed % chunks[name], groups, chunks[name])]
            if len(seen) > REMEMBERED:
                seen.clear()
            yield pd.DataFrame(found, columns=["group", "hashed", "lang", "row"])
        seen.clear()
        give_back()

    return rows.mapInPandas(deal, "group long, hashed long, lang string, row binary"), sorted(counts)


def _mean(found: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of machines, and of how many, by some columns."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("group")  # sums that do not depend on the order of arrival
        total = np.zeros(WIDTH + 1)
        for machine in rows["machine"]:
            total += np.frombuffer(machine, "<f8")
        rows = rows.head(1).assign(machine=[total.tobytes()], times=rows["times"].sum())
        return rows[["one", "other", "group", "machine", "times"]]

    return found.groupBy(*keys).applyInPandas(add, MACHINES)


def fit(docs: DataFrame, training: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from all rows for which ``training`` holds and text and lang are not null.

    Different rows are dealt by hash to groups (``dealt``); each group trains the same
    machines, and each machine of the model is the mean of the groups'.  One group has all
    rows of a small table.  Equal rows count once; every value of lang is learned.
    """
    small_batches(docs.sparkSession)
    usable = docs.filter(training & has_letters(F.col("text")) & F.col("lang").isNotNull())
    rows, languages = dealt(usable, per_language)
    only = len({FAMILY_OF.get(x.lower(), x) for x in languages}) == 1

    def train(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        found = sorted(set(zip(batch["lang"], batch["row"], batch["hashed"])))
        rows = np.zeros((len(found), WIDTH), "<f4")
        for i, (_, row, _) in enumerate(found):
            n = len(row) // 6
            rows[i, np.frombuffer(row, "<u2", n)] = np.frombuffer(row, "<f4", n, 2 * n)
        learned = machines([name for name, _, _ in found], rows, only)
        del rows
        give_back()
        group = int(key[0])
        return pd.DataFrame(
            [(*name, group, np.append(weights, bias).astype("<f8").tobytes(), 1) for name, (weights, bias) in learned.items()],
            columns=["one", "other", "group", "machine", "times"],
        )

    found = rows.groupBy("group").applyInPandas(train, MACHINES)
    # machines of many groups are added up in two steps; only their means reach the driver
    part = F.floor(F.col("group") / ADDED)
    found = _mean(_mean(found.withColumn("part", part), ["one", "other", "part"]), ["one", "other"])
    means = {}
    for r in found.collect():
        mean = np.frombuffer(r.machine, "<f8") / r.times
        means[r.one, r.other] = mean[:-1], float(mean[-1])
    return Model(languages, means)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct(lang_pred, score) of a text column; ``und`` and 0 without any letter."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # WIDTH numbers a machine

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shared.value.predict(features(t)) if t else (UNKNOWN, 0.0) for t in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])
        give_back()

    return judge(F.when(has_letters(text), text))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Rows whose crc32 of doc_id is 2 modulo 4 are held out of the learning; so are rows
    with a null doc_id, whose held_out is false.  A null text or one without letters is
    ``und`` with score 0, as is every text when there is nothing to learn from.
    """
    crc = remainder("doc_id", 4)
    model = fit(docs, crc != 2)
    found = predicted(docs.sparkSession, F.col("text"), model)
    return docs.select(
        "doc_id", F.coalesce(crc == 2, F.lit(False)).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.*")


def least_score(docs: DataFrame, held_out: Column, model: Model) -> float:
    """LEAST, or less where right predictions of the held-out rows score less; 0 without any.

    All held-out rows are counted, by scores rounded down to STEPS steps.
    """
    usable = docs.filter(held_out & has_letters(F.col("text")) & F.col("lang").isNotNull())
    found = usable.select("lang", predicted(docs.sparkSession, F.col("text"), model).alias("found"))
    right = found.filter(F.col("lang") == F.col("found.lang_pred"))
    counted = right.groupBy(F.floor(F.col("found.score") * STEPS).alias("step")).count().collect()
    if not counted:
        return 0.0
    steps, counts = np.array(sorted(tuple(r) for r in counted)).T
    rank = int(0.001 * (counts.sum() - 1))  # from 0
    lowest = steps[np.searchsorted(np.cumsum(counts), rank, side="right")] / STEPS
    return max(0.0, min(LEAST, float(lowest) - BELOW))


def keep_identified(docs: DataFrame, least: float | None = 0.0) -> DataFrame:
    """The rows in a recognised language, with all their columns as they were.

    Rows without any letter, and rows that score less than ``least``, go; with None, less
    than ``least_score`` of the held-out rows.
    """
    crc = remainder("doc_id", 4)
    model = fit(docs, crc != 2)
    if least is None:
        least = least_score(docs, crc == 2, model)
    found = free_name(docs, "found")
    judged = docs.withColumn(found, predicted(docs.sparkSession, F.col("text"), model))
    kept = (F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least)
    return judged.filter(kept).drop(found)
