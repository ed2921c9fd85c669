import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamsync.llm import mixing


def mixture(rows):
    return [r.asDict() for r in rows.collect()]


def docs_of(documents, sizes, repeat=()):
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, " ".join(["w"] * (1 + (k * 7) % 5)), "en", source))
            i += 1
    return documents(rows + list(repeat))


def weights(totals, a):
    z = sum((n / sum(totals.values())) ** a for n in totals.values())
    return {s: (n / sum(totals.values())) ** a / z for s, n in totals.items()}


def totals_of(rows):
    found = {}
    for r in rows:
        found[r["source"]] = r["source_tokens"]
    return found


def test_entropy_is_met(spark, documents):
    docs = docs_of(documents, {"a": 300, "b": 60, "c": 20})
    rows = mixture(mixing.mixed(docs, entropy=0.9))
    found = {r["source"]: r["weight_"] for r in rows}
    assert abs(-sum(w * math.log(w) for w in found.values()) - 0.9) < 1e-6
    assert abs(sum(found.values()) - 1) < 1e-9
    even = mixture(mixing.mixed(docs, entropy=5.0))
    assert {round(r["weight_"], 9) for r in even} == {round(1 / 3, 9)}
    natural = mixture(mixing.mixed(docs, entropy=0.0))
    assert len(natural) == docs.count() and {r["epoch_"] for r in natural} == {0}


def test_repetition_limit_loses_nothing(spark, documents):
    docs = docs_of(documents, {"a": 400, "b": 100, None: 30})
    rows = mixture(mixing.mixed(docs, repetitions=2.0))
    passes = {}
    for r in rows:
        passes[r["source"]] = r["budget_tokens"] / r["source_tokens"]
    assert abs(passes["a"] - 1) < 1e-9 and 1.9 < passes[None] <= 2.0 and 1 < passes["b"] < 2
    assert {r["doc_id"] for r in rows} == {r.doc_id for r in docs.collect()}


def check_blocks(rows, docs):
    """Whole blocks hold every row; the cut one is the longest run of draws that its budget holds."""
    own = defaultdict(list)
    for r in docs.collect():
        own[r.source].append(r)
    for source, members in own.items():
        mine = [r for r in rows if r["source"] == source]
        blocks = defaultdict(list)
        for r in mine:
            blocks[r["epoch_"]].append(r)
        taken = sum(r["n_tokens_"] for r in mine)
        budget, total = mine[0]["budget_tokens"], mine[0]["source_tokens"]
        largest = max(r["n_tokens_"] for r in mine)
        assert budget - largest < taken <= budget
        for epoch in range(budget // total):
            assert sorted(r["doc_id"] for r in blocks[epoch]) == sorted(m.doc_id for m in members)
        whole = budget // total
        if budget % total:
            assert len(blocks[whole]) < len(members)
            assert set(blocks) <= set(range(whole + 1))
        assert all(0 <= r["mix_key"] <= 1 for r in mine)


def test_budgeted_blocks(spark, documents):
    docs = docs_of(documents, {"a": 300, "b": 60, "c": 20})
    rows = mixture(mixing.mixed(docs, repetitions=3.0, budget=2000, seed=4))
    check_blocks(rows, docs)
    by_epoch = defaultdict(list)
    for r in rows:
        if r["source"] == "c":
            by_epoch[r["epoch_"]].append((r["block_key"], r["doc_id"]))
    orders = [[d for _, d in sorted(v)] for e, v in sorted(by_epoch.items()) if len(v) == 20]
    assert len(orders) >= 2 and orders[0] != orders[1]
    again = mixture(mixing.mixed(docs.repartition(7), repetitions=3.0, budget=2000, seed=4))
    key = lambda r: (r["doc_id"], r["epoch_"], r["block_key"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    other = mixture(mixing.mixed(docs, repetitions=3.0, budget=2000, seed=5))
    assert sorted(map(key, rows)) != sorted(map(key, other))


def test_the_cut_is_where_the_budget_ends(spark, documents):
    docs = docs_of(documents, {"a": 200})
    rows = mixture(mixing.mixed(docs, repetitions=9.0, budget=100))
    every = mixture(mixing.mixed(docs, repetitions=9.0, budget=sum(r["n_tokens_"] for r in rows) + 10**4))
    draws = sorted((r["block_key"], r["n_tokens_"]) for r in every if r["epoch_"] == 0)
    expected, used = [], 0
    for key, n in draws:
        if used + n > 100:
            break
        used += n
        expected.append(key)
    assert sorted(r["block_key"] for r in rows) == expected


def test_odd_rows(spark, documents):
    same = [(7, "one two three", None, "hot")] * 40
    odd = [(None, None, None, None), (1, "", "en", "empty"), (2, "   ", "en", "empty"), (3, "x " * 100_000, "en", "long")]
    docs = documents(same + odd)
    rows = mixture(mixing.mixed(docs, repetitions=2.0))
    assert {r["source"] for r in rows} == {"hot", "empty", "long", None}
    assert sum(r["source"] == "empty" for r in rows) == 2
    assert {r["weight_"] for r in rows if r["source"] in ("empty", None)} == {0.0}
    assert sum(r["doc_id"] == 7 for r in rows) >= 40
    cut = mixture(mixing.mixed(documents(same), repetitions=1.0, budget=50))
    assert len(cut) == 16  # of forty equal rows of three tokens
    assert mixing.mixed(docs.limit(0), entropy=1.0).count() == 0
    plain = mixing.mixed_documents(docs, repetitions=2.0)
    assert plain.columns == docs.columns
    with pytest.raises(ValueError):
        mixing.mixed(docs)


def test_op10_on_the_tables(spark):
    from streamsync.llm import queries

    sf = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in queries.op10_source_mixing(spark, sf).collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("n", mixing.words(F.col("text")))
    totals = {r.source: r.n for r in docs.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    assert totals_of(rows) == totals
    low, high = 0.0, 1.0  # a plain bisection
    ratio = max(totals.values()) / min(totals.values())
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if ratio ** (1 - middle) <= queries.REPETITIONS else (middle, high)
    expected = weights(totals, high)
    for r in rows:
        assert abs(r["weight"] - expected[r["source"]]) < 1e-6
    assert {r["doc_id"] for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
