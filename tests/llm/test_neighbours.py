import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamsync.llm import neighbours


def test_hilbert_curve_walks_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def vectors_table(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, query boolean")
    return df.select("*", F.lit(1).alias("rank"), F.lit(1.0).alias("score"), F.lit("k").alias("key"), F.lit(2).alias("vid"))


def brute(rows, k):
    use = {}
    for i, v, q in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            use[i, tuple(v)] = use.get((i, tuple(v)), False) or bool(q)
    out = []
    for (i, v), asked in use.items():
        if asked:
            near = []
            for (j, w) in use:
                if j != i:
                    a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                    near.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 9), j))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def odd_rows():
    draw = np.random.default_rng(0)
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist(), i % 4 == 0) for i in range(60)]
    rows += [(100 + i, rows[0][1], i < 3) for i in range(20)] + [rows[4], rows[5]]
    rows += [
        (200, None, True), (201, [0.0] * 8, True), (202, [1.0, None] + [0.0] * 6, True), (203, [float("nan")] + [1.0] * 7, False),
        (204, [float("inf")] + [1.0] * 7, True), (205, [1.0, 2.0], True), (None, [1.0] * 8, True), (206, [1.0] * 8, None),
    ]
    return rows


def test_small_tables_are_searched_exactly(spark):
    rows = odd_rows()
    got = found(neighbours.search(vectors_table(spark, rows), k=5))
    assert got == brute(rows, 5)
    assert found(neighbours.search(vectors_table(spark, rows), k=5, window=8, share=1.0)) == got


def test_few_rows(spark):
    rows = odd_rows()
    assert found(neighbours.search(vectors_table(spark, rows[:3]), k=5)) == brute(rows[:3], 5)
    assert neighbours.search(vectors_table(spark, rows[:1]), k=5).count() == 0
    assert neighbours.search(vectors_table(spark, rows).limit(0), k=5).count() == 0
    assert neighbours.search(vectors_table(spark, rows).filter("not query"), k=5).count() == 0


def test_doubles_keep_their_precision(spark):
    rows = [(0, [1.0, 1e-9], True), (1, [1.0, 2e-9], False), (2, [1e300, 1e300], False)]
    got = neighbours.search(vectors_table(spark, rows, "double"), k=2).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])][0] == 1


@pytest.mark.parametrize("noise", [1e-3, 1e-5])
def test_recall_in_a_tight_cluster_over_many_windows(spark, noise):
    draw = np.random.default_rng(3)
    values = draw.normal(size=(6000, 32)) / 32**0.5
    middle = draw.normal(size=32)
    values[::3] = middle / np.linalg.norm(middle) + noise * draw.normal(size=(2000, 32))
    rows = [(i, v.tolist(), i % 120 == 0) for i, v in enumerate(values)]  # queries from the cluster
    vectors = vectors_table(spark, rows, "double")
    assert neighbours.recall(neighbours.search(vectors, k=5, window=64), vectors) >= 0.9


def test_multiples_of_a_vector_are_one_direction(spark):
    draw = np.random.default_rng(4)
    values = draw.integers(-9, 10, size=(3000, 8)).astype(float)
    values[1000:] = np.outer(np.arange(1, 2001), values[0])
    rows = [(i, v.tolist(), i in (0, 2999)) for i, v in enumerate(values)]
    got = found(neighbours.search(vectors_table(spark, rows), k=5, window=32))
    assert [r[:3] for r in got if r[0] == 2999] == [(2999, n + 1, v) for n, v in enumerate([0, 1000, 1001, 1002, 1003])]
    assert [r[2] for r in got if r[0] == 0] == [1000, 1001, 1002, 1003, 1004]


def test_op9_recall(spark):
    from streamsync.llm import queries

    sf = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").withColumn("query", F.col("vec_id") % 50 == 0)
    rows = queries.op9_nearest_neighbours(spark, sf)
    assert rows.groupBy("query_id").count().filter("count <> 5").count() == 0
    assert neighbours.recall(rows, vectors) >= 0.9
    narrow = neighbours.search(vectors, k=5, window=64)  # the share of rows met is what counts
    assert neighbours.recall(narrow, vectors) >= 0.9
