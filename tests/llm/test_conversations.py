import hashlib
import random
import re

import pytest

from streamsync.llm import conversations
from streamsync.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string, slots string, place string, first string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def cheapest(rows):
    """All ways through a conversation: cost, audit and text of the cheapest, least one."""
    seen, faults = set(), []
    for role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = (4 * len(rows), "D" * len(rows), "")

    def go(i, roles, audit, out, cost, inserted):
        nonlocal best
        if cost > best[0] or not re.fullmatch("(s?(ua)*u?)?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best, (cost, audit, "\n".join(out)))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, roles + role[0], audit + "I", [*out, f"{role}:"], cost + 3, inserted + 1)
        if i == len(rows):
            return
        role, text = rows[i]
        go(i + 1, roles, audit + "D", out, cost + 4, 0)
        if faults[i] not in ("blank", "duplicate"):
            more = 3 if faults[i] else 0
            if role[:1] in ("s", "u", "a"):
                go(i + 1, roles + role[0], audit + "K", [*out, f"{role}:{text}"], cost + more, 0)
            for new in ("user", "assistant"):
                go(i + 1, roles + new[0], audit + "R", [*out, f"{new}:{text}"], cost + more + 3, 0)

    go(0, "", "", [], 0, 0)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (*best[:2], hashlib.sha256(best[2].encode()).hexdigest(), *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal)


def results(spark, rows, every=None):
    report = conversations.audit(rows, every)
    hashes = {r.conv_id: r.sha256 for r in conversations.digests(conversations.repaired(rows, report)).collect()}
    empty = hashlib.sha256().hexdigest()
    return {
        r.conv_id: (r.cost, r.audit, hashes.get(r.conv_id, empty), r.blank, r.duplicate, r.truncated, r.illegal, r.gaps)
        for r in report.collect()
    }


@pytest.mark.parametrize("segment", [512, 2])
def test_equals_all_ways(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    pick = random.Random(7)
    convs = {}
    for i in range(60):
        roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "s"]
        convs[i] = [(pick.choice(roles), pick.choice(["a.", "b?", "c!", "d", " ", "", "e. \n"])) for _ in range(pick.randint(1, 5))]
    rows = [(i, t, *m) for i, messages in convs.items() for t, m in enumerate(messages)]
    pick.shuffle(rows)
    got = results(spark, table(spark, rows))
    assert got == {i: (*cheapest(m), 0) for i, m in convs.items()}


def test_a_long_conversation_in_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 16)
    pick = random.Random(3)
    messages = [(pick.choice(["user", "assistant", "system"]), f"{i}{pick.choice(['.', '?', ''])}") for i in range(300)]
    rows = table(spark, [(1, t, *m) for t, m in enumerate(messages)] + [(2, t, *m) for t, m in enumerate(messages)])
    got = results(spark, rows)
    monkeypatch.setattr(conversations, "SEGMENT", 512)
    assert got == results(spark, rows) and got[1] == got[2]
    whole = conversations._weights([(r[0], 0 if t[-1] in ".?" else 1) for r, t in messages])
    cost, slots = conversations._finished(whole[0], 300)
    assert (got[1][0], got[1][1]) == (cost, slots.replace(" ", ""))


def test_odd_input(spark):
    rows = table(spark, [
        (1, None, "user", "first."), (1, 5, None, None), (1, 9, "assistant", "yes."), (1, 9, "assistant", "yes."),
        (None, 1, "user", "hi."), (None, 2, "assistant", "ho."), (3, None, "user", "x"), (2**62, 1, "user", "y."),
    ])
    every = spark.createDataFrame([(1,), (8,), (None,)], "conv_id long")
    got = results(spark, rows, every)
    assert set(got) == {1, None, 3, 2**62, 8}
    assert got[1] == (*cheapest([("user", "first."), (" ", " "), ("assistant", "yes."), ("assistant", "yes.")]), 3)
    assert got[None][:2] == (0, "KK") and got[8] == (0, "", hashlib.sha256().hexdigest(), 0, 0, 0, 0, 0)
    assert got[3][:2] == (4, "D") and got[2**62][:2] == (3, "KI")
    assert results(spark, rows.limit(0)) == {}


def test_one_conversation_holds_a_third_of_all_rows(spark):
    rows = [(0, t, "ua"[t % 2], f"{t}.") for t in range(3000)]
    rows += [(1 + t // 2, t % 2, ("user", "assistant")[t % 2], f"{t}.") for t in range(6000)]
    got = results(spark, table(spark, [(c, t, {"u": "user", "a": "assistant"}.get(r, r), x) for c, t, r, x in rows]).repartition(8))
    assert len(got) == 3001 and got[0][:2] == (0, "K" * 3000)
    assert all(g[0] == 0 and g[1] == "KK" for c, g in got.items() if c)


def test_damage_by_hash(spark):
    rows = table(spark, [(i, t, "assistant", "A b. C!") for i in range(30) for t in range(4)])
    from zlib import crc32

    want = []
    for r in rows.collect():
        fault = crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else "A b C" if fault == 2 else "A b. C!"
        want += [(r.conv_id, r.turn, "user" if fault == 4 else "assistant", text)] * ((fault != 0) + (fault == 3))
    assert sorted(map(tuple, damaged(rows).collect())) == sorted(want)
