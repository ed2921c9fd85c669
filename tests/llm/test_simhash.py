import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from streamsync.llm import simhash
from streamsync.llm.common import many_rows


def plain(text):
    words = (text or "").encode().translate(simhash._ASCII_LOWER).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_of(prints, tau=4):
    """Component of each fingerprint by comparing all pairs: its smallest member."""
    values = np.array(prints, np.uint64)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= tau):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def connected(spark, prints, tau=4):
    table = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "simhash long")
    with many_rows(spark):
        edges = simhash.links(table, simhash.plan_for(table, tau)).collect()
    place = {p: i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        a, b = e.a & (1 << 64) - 1, e.b & (1 << 64) - 1
        assert (a ^ b).bit_count() <= tau
        a, b = root(place[a]), root(place[b])
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def crowd(n, seed, spread):
    """Fingerprints at random, and a crowd that differs from one in a few bits."""
    pick = random.Random(seed)
    found = {pick.getrandbits(64) for _ in range(n)}
    centre = pick.getrandbits(64)
    while len(found) < 2 * n:
        value = centre
        for _ in range(pick.randint(0, spread)):
            value ^= 1 << pick.randrange(64)
        found.add(value)
    return sorted(found)


@pytest.mark.parametrize("block", [4096, 16])
def test_links_connect_what_is_near(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = crowd(150, 5, 9)
    assert connected(spark, prints) == least_of(prints)


def test_correlated_bits_and_every_number_of_parts(spark):
    pick = random.Random(8)
    prints = sorted({sum(((v >> b & 1) * 3) << 2 * b for b in range(32)) ^ (1 << pick.randrange(64)) for v in (pick.getrandbits(12) << 9 for _ in range(200))})
    table = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "simhash long")
    correlation = simhash._correlation(table)
    paired = sum(any(2 * b in part and 2 * b + 1 in part for part in simhash.parts_of(correlation, 4)) for b in range(9, 21))
    assert paired >= 10
    want = least_of(prints)
    for m in (2, 3, 4, 5):
        parts = simhash.parts_of(correlation, m)
        assert sorted(b for p in parts for b in p) == list(range(64))
        pieces = [p for part in parts for p in simhash._pieces(part)]
        histograms = dict(zip(map(tuple, pieces), simhash._histograms(table, pieces)))
        plan = simhash.Plan(parts, histograms, 4)
        _, thresholds = plan.thresholds(np.array(prints, np.uint64))
        assert (thresholds.sum(axis=0) == 4 - m + 1).all()
        edges = {(e.a & (1 << 64) - 1, e.b & (1 << 64) - 1) for e in simhash.links(table, plan).collect()}
        got = least_of_edges(prints, edges)
        assert got == want


def least_of_edges(prints, edges):
    place, parent = {p: i for i, p in enumerate(prints)}, list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(place[a]), root(place[b])
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_estimates_are_exact_where_parts_are_whole(spark):
    prints = np.array(crowd(100, 2, 3), np.uint64)
    part = list(range(8))
    count = np.bincount(simhash._values(prints, part).astype(int), minlength=256)
    near = np.cumsum(simhash._within(count, 4), axis=0)
    values = np.repeat(np.arange(256), count)
    for value in (0, 3, 77, 255):
        for distance in range(5):
            assert near[distance][value] == (np.bitwise_count(values ^ value) <= distance).sum()


def test_components_of_documents(spark, documents):
    pick = random.Random(1)
    base = [" ".join(f"w{pick.randrange(900)}" for _ in range(120)) for _ in range(4)]
    texts = [*base, base[0] + " tail", base[1].upper(), "one two", "ONE\ttwo ", None, "", " \n", "x" * 300_000]
    texts += [base[2].replace("w1", "w2", 1), " ".join(["word"] * 50_000)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(0, base[0], "en", "s"), (None, base[3], "en", "s")]
    got = simhash.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    prints = sorted({plain(t) for _, t, _, _ in rows})
    root = least_of(prints)
    of = {p: root[i] for i, p in enumerate(prints)}
    least = {}
    for i, t, _, _ in rows:
        if i is not None:
            least[of[plain(t)]] = min(i, least.get(of[plain(t)], i))
    want = sorted(((i, plain(t), least.get(of[plain(t)])) for i, t, _, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.simhash & (1 << 64) - 1, r.component_id) for r in got), key=repr) == want


def test_no_documents_and_only_null_ids(spark, documents):
    assert simhash.near_duplicates(documents([(1, "a", "en", "s")]).filter(F.lit(False))).count() == 0
    assert [r.component_id for r in simhash.near_duplicates(documents([(None, "a b", "en", "s")])).collect()] == [None]
