"""Conversations brought into the order that training wants, by their cheapest edits.

A conversation is well formed if the first letters of its roles read ``(s?(ua)+)?``.  Edits:
keep a message (0), give it the role user or assistant (3), delete it (4; blank and repeated
ones must go), insert an empty message of the user or the assistant (3); a message that
breaks off and stays costs 3 more.

The way through a conversation is a path in a DAG whose nodes are (messages so far, what may
come next).  The weight of an edge is one integer: its cost in the high digits; below them
every message has a slot of two digits for the letters of its edits, left first, filled up
with zeros at its end.  The order of the slots is that of the audits as text: two ways differ
first within the slot of one message, where either the letters differ or both end.  So the
smallest integer is the cheapest way, and of these the one with the least audit, and an
ordinary minimum at each node decides everything.  More than one insertion between two
messages, or one before a deletion, is never in the cheapest, least way: taking both out is
cheaper, a deletion first is less.

Long conversations are cut: rows are dealt by ranges of (conversation, turn), each stretch of
SEGMENT rows becomes a small matrix of weights between what may come next before and after
it, and a conversation's matrices are folded in order.  Weights of two stretches are added by
shifting the first beyond the digits of the second.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import small_batches, stored

#: Rows of a conversation that become one matrix.
SEGMENT = 512
#: Costs of the edits.
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3

_LETTERS = "\0DIKR"  # in ASCII order
_DIGIT = {letter: i for i, letter in enumerate(_LETTERS)}
_SLOT = 6  # bits of two digits
#: What may come next: anything, user (after system), assistant, user (all well so far).
_START, _SYSTEM, _USER, _WHOLE = range(4)
_WANTED = {_START: "u", _SYSTEM: "u", _USER: "a", _WHOLE: "u"}
_AFTER = {"u": _USER, "a": _WHOLE}
_OTHER = {"u": "a", "a": "u"}

_WORD = r"[^\x20\x09-\x0D]"


def _slot(letters: str) -> int:
    return _DIGIT[letters[0]] << 3 | (_DIGIT[letters[1]] if len(letters) > 1 else 0)


def _edges(initial: str, must_go: bool, broken: bool) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, slot) of all ways past one message."""
    edges = [(at, at, DELETE, _slot("D")) for at in range(4)]
    if must_go:
        return edges
    more = BROKEN if broken else 0
    if initial == "s":
        edges.append((_START, _SYSTEM, more, _slot("K")))
    for at, wanted in _WANTED.items():
        other = _OTHER[wanted]
        for role, before, cost in ((wanted, "", 0), (other, "I", INSERT)):
            if initial == role:
                edges.append((at, _AFTER[role], more + cost, _slot(before + "K")))
            else:
                edges.append((at, _AFTER[role], more + cost + REROLE, _slot(before + "R")))
    return edges


_EDGES = {
    (initial, fault): _edges(initial, fault == 2, fault == 1) for initial in ("s", "u", "a", "") for fault in (0, 1, 2)
}


def _weights(rows: list[tuple[str, int]], begins: bool = False) -> list[list[int | None]]:
    """Least weight of a stretch from each node before it to each node after it; a
    conversation that ``begins`` here has only one node before it."""
    n = len(rows)
    matrix = []
    for entry in range(4):
        if begins and entry != _START:
            matrix.append([None] * 4)
            continue
        best: list[int | None] = [None] * 4
        best[entry] = 0
        for i, row in enumerate(rows):
            shift, after = _SLOT * (n - 1 - i), [None] * 4
            for come, go, cost, slot in _EDGES[row]:
                if best[come] is not None:
                    way = best[come] + (cost << _SLOT * n) + (slot << shift)
                    if after[go] is None or way < after[go]:
                        after[go] = way
            best = after
        matrix.append(best)
    return matrix


def _joined(one: int, two: int, before: int, after: int) -> int:
    """The weight of two stretches of so many rows."""
    digits = _SLOT * after
    cost, letters = two >> digits, two & ((1 << digits) - 1)
    return (one << digits) + (cost << digits + _SLOT * before) + letters


def _finished(best: list[int | None], rows: int) -> tuple[int, str]:
    """Cost and slots (two characters a row, one for the end) of the best way."""
    digits = _SLOT * rows + 3  # one more digit: an assistant may be added at the end
    ends = []
    for at, extra in ((_START, 0), (_WHOLE, 0), (_USER, (INSERT << digits) + _DIGIT["I"])):
        if best[at] is not None:
            ends.append((best[at] << 3) + extra)
    least = min(ends)
    octal = format(least & ((1 << digits) - 1), "o").zfill(2 * rows + 1)
    return least >> digits, octal.translate(_NAMES)


_NAMES = str.maketrans({str(i): letter if i else " " for i, letter in enumerate(_LETTERS)})


def _light(rows: DataFrame) -> DataFrame:
    """What the edits depend on, without the texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    named = F.concat_ws(":", conv, F.length(role).cast("string"), role, text)
    last = F.regexp_extract(text, rf"({_WORD})[\x20\x09-\x0D]*\z", 1)
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.unhex(F.sha2(named, 256)).alias("digest"),
        F.substring(role, 1, 1).alias("initial"),
        (~text.rlike(_WORD)).alias("blank"),
        (~last.rlike("[.!?]")).alias("broken"),
    )


_SEGMENT = (
    "conv_id long, turn0 long, digest0 binary, seg long, n long, blank long, duplicate long, truncated long, "
    "illegal long, first string, last string, low long, high long, turns long, turn1 long, weights array<binary>"
)
_LEGAL = {"su", "ua", "au"}


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _bytes(way: int | None) -> bytes | None:
    return None if way is None else way.to_bytes((way.bit_length() + 7) // 8, "big")


def _segments(marked: DataFrame) -> DataFrame:
    """Stretches of each conversation, of rows dealt by range."""
    form = _arrow(_SEGMENT)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, now, classes, previous = [], None, [], None
        conversations = 0

        def close() -> None:
            now["n"] = len(classes)
            # only a partition's first conversation may have rows in the one before
            begins = now["seg"] == 0 and conversations > 1
            now["weights"] = [_bytes(way) for line in _weights(classes, begins) for way in line]
            found.append(now)

        for batch in batches:
            for conv, turn, digest, initial, blank, broken, again in zip(*(c.to_pylist() for c in batch.columns)):
                new = now is None or conv != now["conv_id"]
                if new or len(classes) == SEGMENT:
                    if now is not None:
                        close()
                    number = 0 if new else now["seg"] + 1
                    conversations += new
                    now = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
                    now |= {"conv_id": conv, "turn0": turn, "digest0": digest, "seg": number, "first": initial}
                    now |= {"low": None, "high": None, "last": None, "turn1": None}
                    classes = []
                    if new:
                        previous = None
                again = again or previous == (turn, digest)
                previous = turn, digest
                fault = "blank" if blank else "duplicate" if again else "truncated" if broken else None
                if fault:
                    now[fault] += 1
                if now["last"] is not None and now["last"] + initial not in _LEGAL:
                    now["illegal"] += 1
                now["last"] = initial
                if turn is not None:
                    now["turns"] += now["turn1"] is None or turn != now["turn1"]
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"] = now["turn1"] = turn
                kind = 0 if fault is None else 1 if fault == "truncated" else 2
                classes.append((initial if initial in ("s", "u", "a") else "", kind))
            if len(found) >= 64:
                yield pa.RecordBatch.from_pylist(found, form)
                found = []
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist(found, form)

    dealt = marked.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    return dealt.mapInArrow(measure, _SEGMENT)


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "slots string"
)


def _folded(segments: DataFrame) -> DataFrame:
    """One row a conversation, of its stretches in order."""
    form = _arrow(_REPORT)
    counts = ("blank", "duplicate", "truncated", "illegal")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, now = [], None

        def begin(conv: int | None) -> dict:
            best: list[int | None] = [0, None, None, None]
            return dict.fromkeys(counts, 0) | {
                "conv_id": conv, "best": best, "rows": 0, "last": None, "low": None, "high": 0, "turns": 0, "turn1": None,
            }

        def close() -> None:
            cost, slots = _finished(now["best"], now["rows"])
            report = {c: now[c] for c in ("conv_id", *counts)}
            gaps = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
            found.append(report | {"gaps": gaps, "cost": cost, "slots": slots, "audit": slots.replace(" ", "")})

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"]:
                    if now is not None:
                        close()
                    now = begin(row["conv_id"])
                if not row["n"]:
                    continue
                for count in counts:
                    now[count] += row[count]
                if now["last"] is not None and now["last"] + row["first"] not in _LEGAL:
                    now["illegal"] += 1
                now["last"] = row["last"]
                if row["low"] is not None:
                    now["turns"] += row["turns"] - (now["turn1"] == row["low"])
                    now["low"] = row["low"] if now["low"] is None else now["low"]
                    now["high"], now["turn1"] = row["high"], row["turn1"]
                after: list[int | None] = [None] * 4
                for come, way in enumerate(now["best"]):
                    for go, more in enumerate(row["weights"][4 * come : 4 * come + 4]):
                        if way is not None and more is not None:
                            both = _joined(way, int.from_bytes(more, "big"), now["rows"], row["n"])
                            after[go] = both if after[go] is None else min(after[go], both)
                now["best"] = after
                now["rows"] += row["n"]
            if len(found) >= 512:
                yield pa.RecordBatch.from_pylist(found, form)
                found = []
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist(found, form)

    order = ["conv_id", "turn0", "digest0", "seg"]
    return segments.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(fold, _REPORT)


def audit(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row a conversation of ``rows`` (conv_id and turn longs, role, text): conv_id; gaps,
    the turns that lack between the smallest and largest; the messages that are blank (no
    character but white space), duplicate (role and text came before) or truncated (the last
    character ends no sentence), each counted for its first fault; illegal, the adjacent pairs
    of roles that may not follow each other; cost; audit, the letters of the cheapest edits;
    slots, the same with two places a message (and one for the end).

    Messages are taken by turn, nulls first, those of one turn by a hash of role and text.  A
    null role or text is one space.  Null conversation ids are one conversation.  ``every``
    names further conversations (conv_id) that may have no rows: zeros and an empty audit.  An
    empty table gives no rows.  Other columns are not looked at.
    """
    small_batches(rows.sparkSession)
    light = _light(rows.withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")}))
    light = light.drop("role", "text")
    # repeated messages: those after the first turn that has them
    key = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0).cast("long")))
    first = light.groupBy(F.col("digest").alias("of")).agg(F.count("*").alias("times"), F.min(key).alias("first"))
    joined = light.join(first.filter("times > 1"), F.col("digest") == F.col("of"), "left")
    marked = joined.select(
        "conv_id", "turn", "digest", "initial", "blank", "broken", F.coalesce(key > F.col("first"), F.lit(False)).alias("again")
    )
    segments = _segments(stored(marked, "messages"))
    if every is not None:
        names = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        segments = segments.unionByName(names.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    return stored(_folded(segments), "conversations")


_MESSAGE = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The messages after the edits of ``report``: conv_id, place (from 0), edit (its letter),
    role, text.  The rows of a conversation lie in one partition, in their order, so what
    follows may read them as a stream; a task holds one batch of them, however many there are.
    """
    small_batches(rows.sparkSession)
    form = _arrow(_MESSAGE)
    texts = _light(rows.withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")}))
    texts = texts.select("conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text")
    plans = report.filter("length(audit) > 0").select("conv_id", F.lit(0).alias("kind"), F.col("slots").alias("text"))
    both = texts.unionByName(plans, allowMissingColumns=True)
    order = ["conv_id", "kind", "turn", "digest"]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = slots = None
        at = place = 0
        state = _START
        out: list[dict] = []

        def put(letter: str, role: str, text: str) -> None:
            nonlocal place, state
            out.append({"conv_id": conv, "place": place, "edit": letter, "role": role, "text": text})
            state = _SYSTEM if role[:1] == "s" else _AFTER[role[0]]
            place += 1

        def wanted() -> str:
            return "assistant" if _WANTED[state] == "a" else "user"

        def end() -> None:
            if slots is not None and slots[-1] == "I":
                put("I", wanted(), "")

        for batch in batches:
            for name, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))):
                if kind == 0:
                    end()
                    conv, slots, at, place, state = name, text, 0, 0, _START
                    continue
                letters = slots[at : at + 2].strip()
                at += 2
                if letters[0] == "I":
                    put("I", wanted(), "")
                if letters[-1] == "K":
                    put("K", role, text)
                elif letters[-1] == "R":
                    put("R", wanted(), text)
            if out:
                yield pa.RecordBatch.from_pylist(out, form)
                out.clear()
        end()
        yield pa.RecordBatch.from_pylist(out, form)

    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(edit, _MESSAGE)


def digests(messages: DataFrame) -> DataFrame:
    """conv_id, sha256 of each conversation's ``role:text`` lines, of ``repaired`` messages.
    A digest has to see a conversation in its order: it runs along the stream of its rows."""

    form = _arrow("conv_id long, sha256 string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = digest = None
        for batch in batches:
            out = []
            for name, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest is not None:
                        out.append({"conv_id": conv, "sha256": digest.hexdigest()})
                    conv, digest = name, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, form)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "sha256": digest.hexdigest()}], form)

    return messages.mapInArrow(hashed, "conv_id long, sha256 string")
