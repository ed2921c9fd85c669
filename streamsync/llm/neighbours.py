"""Approximate nearest neighbours by shifted space-filling curves.

Every ordering turns the vectors by its own random rotation, keeps a few coordinates,
shifts them, and walks them along a Hilbert curve.  Rows are range-partitioned by their
place on the curve and cut into windows of one size; a query meets all rows of the
windows around its own.  What the orderings find is merged and ranked by exact cosines.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamsync.llm.common import stored

#: Bits of a coordinate on the curve, if the key has room for them: so fine that the rows of
#: a tight cluster keep an order of their own along each curve.
BITS = 15
#: An ordering's grid is shifted by up to this part of its width.
SHIFT = 1 / 64


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each row of unsigned coordinates (below 2**bits) along the curve.

    Skilling's transposed Gray code, on all rows at once; bits * columns is 63 at most.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _orderings(dims: int, orderings: int, kept: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A projection onto ``kept`` orthogonal directions and a shift for each ordering."""
    random = np.random.Generator(np.random.PCG64(seed))
    found = []
    for _ in range(orderings):
        directions, _ = np.linalg.qr(random.standard_normal((dims, min(kept, dims))))
        found.append((directions, random.random(directions.shape[1])))
    return found


def curve_keys(vectors: np.ndarray, directions: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Places on the curve of unit vectors: projected, spread over the grid, shifted.

    A coordinate of a unit vector of d components is about 1/sqrt(d); the grid spans four
    times that to either side, and what lies outside sits on its rim.
    """
    bits = min(BITS, 63 // directions.shape[1])
    cells = 1 << bits
    spread = vectors @ directions * np.sqrt(vectors.shape[1]) / 8 + 0.5
    cell = np.floor((spread + shift * SHIFT) * cells)
    return hilbert_keys(np.clip(cell, 0, cells - 1).astype(np.int64), bits)


def direction(embedding: str) -> Column:
    """The components over the largest one, in double precision: the same for all positive
    multiples of a vector."""
    wide = F.col(embedding).cast("array<double>")
    largest = F.array_max(F.transform(wide, F.abs))
    return F.transform(wide, lambda x: x / largest)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, query: once each, without what takes no part: a null id, null or
    zero vectors, null or non-finite components, another length than most rows have."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    numbers = "array<float>" if single else "array<double>"
    rows = vectors.select(
        "vec_id", F.col("embedding").cast(numbers).alias("embedding"), F.coalesce("query", F.lit(False)).alias("query")
    ).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.filter(finite & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    size = sizes.first()
    return rows.filter(F.size("embedding") == (size["n"] if size else 0)).distinct()


def recall(found: DataFrame, vectors: DataFrame, k: int = 5) -> float:
    """The part of the true ``k`` nearest ones of every query that ``found`` has; compares
    each query with every row, in blocks, and is meant for tests."""
    rows = usable(vectors)
    queries = rows.filter("query").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in queries])
    ours = np.array([r[1] for r in queries], dtype=np.float64)
    ours /= np.linalg.norm(ours, axis=1, keepdims=True)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in batches:
            theirs = np.stack(block["embedding"].to_numpy()).astype(np.float64)
            scores = ours @ (theirs / np.linalg.norm(theirs, axis=1, keepdims=True)).T
            scores[ids[:, None] == block["vec_id"].to_numpy()[None, :]] = -2
            few = min(k, len(block))
            top = np.argsort(-scores, axis=1, kind="stable")[:, :few]
            yield pd.DataFrame(
                {"q": np.repeat(ids, few), "v": block["vec_id"].to_numpy()[top].ravel(),
                 "s": np.take_along_axis(scores, top, 1).ravel()}
            )

    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "v"))
    true = rows.select("vec_id", "embedding").mapInPandas(best, "q long, v long, s double")
    true = true.filter("s > -1.5").withColumn("nth", nth).filter(F.col("nth") <= k)
    both = true.join(found, (F.col("q") == F.col("query_id")) & (F.col("v") == F.col("vec_id")), "left")
    return both.agg(F.avg(F.col("vec_id").isNotNull().cast("double"))).first()[0]


def search(
    vectors: DataFrame,
    k: int = 5,
    orderings: int = 12,
    kept: int = 4,
    share: float = 0.1,
    window: int = 1024,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row marked ``query``.

    ``vectors`` has vec_id, embedding and query.  In each ordering a query meets the
    windows around its own that hold ``share`` of all rows.  Score is the cosine in double
    precision; ties go to the smaller vec_id.  Vectors of one direction are searched once and
    stand for their ids; a query is not its own neighbour.  With few rows fewer are returned.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vectors")
    # one row a direction, with its k + 1 smallest ids: all that a query can need
    turned = rows.withColumn("direction", direction("embedding"))
    nth = F.dense_rank().over(Window.partitionBy("direction").orderBy("vec_id"))
    few = turned.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    asked = turned.filter("query").select(F.col("direction").alias("asked")).distinct()
    distinct = few.groupBy("direction").agg(
        F.sort_array(F.collect_set("vec_id")).alias("ids"), F.min(F.struct("vec_id", "embedding"))["embedding"].alias("embedding")
    )
    distinct = distinct.join(asked, F.col("direction") == F.col("asked"), "left")
    distinct = stored(
        distinct.select(F.col("ids")[0].alias("vid"), "ids", "embedding", F.col("asked").isNotNull().alias("query")),
        "distinct-vectors",
    )
    total, queries, dims = distinct.agg(
        F.count("*"), F.coalesce(F.sum(F.col("query").cast("long")), F.lit(0)), F.max(F.size("embedding"))
    ).first()
    if not queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    placed = _placed(distinct, _orderings(dims, orderings, kept, seed), total)
    found = _met(placed, total, queries, k, share, window)

    best = Window.partitionBy("query_vid").orderBy(F.desc("score"), "vid")
    few = found.groupBy("query_vid", "vid").agg(F.max("score").alias("score"))
    few = few.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    named = few.join(distinct.select(F.col("vid").alias("v"), "ids"), F.col("vid") == F.col("v"))
    # a direction stands for its ids, so k + 1 directions give k + 1 ids or more
    each = named.select("query_vid", "score", F.explode("ids").alias("vec_id"))
    nearest = Window.partitionBy("query_vid").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k + 1)
    lists = each.groupBy("query_vid").agg(F.collect_list(F.struct("nth", "vec_id", "score")).alias("list"))
    of_vector = distinct.filter("query").select(direction("embedding").alias("direction"), F.col("vid").alias("query_vid"))
    of_vector = of_vector.join(lists, "query_vid")
    asking = turned.filter("query").select(F.col("vec_id").alias("query_id"), F.col("direction").alias("own"))
    answers = asking.join(of_vector, F.col("own") == F.col("direction"))
    others = F.filter(F.sort_array("list"), lambda r: r["vec_id"] != F.col("query_id"))
    return answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id"), F.col("hit.score")
    )


def _placed(distinct: DataFrame, curves: list, total: int) -> DataFrame:
    """vid, embedding, query, ordering and place: the row's rank along each curve.

    Only ids and keys are sorted; a vector is joined to its places afterwards.
    """
    spark = distinct.sparkSession

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                values = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
                values /= np.abs(values).max(axis=1, keepdims=True)
                values /= np.linalg.norm(values, axis=1, keepdims=True)
                for i, (directions, shift) in enumerate(curves):
                    key = curve_keys(values, directions, shift)
                    yield pd.DataFrame({"vid": rows["vid"], "ordering": i, "key": key})

    keyed = distinct.select("vid", "embedding").mapInPandas(walk, "vid long, ordering int, key long")
    parts = max(len(curves), -(-total * len(curves) // 65536))
    keyed = stored(keyed, "curve-keys")
    # equal keys stand in another order along each curve
    order = ["ordering", "key", "tie", "vid"]
    keyed = keyed.withColumn("tie", F.xxhash64("ordering", "vid"))
    along = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), {}
        for rows in batches:
            nth = rows.groupby("ordering").cumcount().to_numpy()
            base = rows["ordering"].map(lambda o: seen.get(o, 0)).to_numpy()
            for o, n in rows["ordering"].value_counts().items():
                seen[o] = seen.get(o, 0) + n
            yield rows.drop(columns=["key", "tie"]).assign(part=part, nth=nth + base)

    numbered = stored(along.mapInPandas(count, "vid long, ordering int, part int, nth long"), "curve-order")
    sizes = numbered.groupBy("ordering", "part").count().collect()  # a row a partition
    begins, before = [], {}
    for o, part, n in sorted(map(tuple, sizes)):
        begins.append((o, part, before.get(o, 0)))
        before[o] = before.get(o, 0) + n
    begins = spark.createDataFrame(begins, "o int, p int, base long")
    here = (F.col("ordering") == F.col("o")) & (F.col("part") == F.col("p"))
    place = F.struct("ordering", (F.col("base") + F.col("nth")).alias("place"))
    places = (
        numbered.join(F.broadcast(begins), here)
        .groupBy(F.col("vid").alias("placed"))
        .agg(F.collect_list(place).alias("places"))  # one for each curve
    )
    joined = distinct.join(places, F.col("vid") == F.col("placed"))
    joined = stored(joined.select("vid", "embedding", "query", "places"), "placed-vectors")
    return joined.select("vid", "embedding", "query", F.explode("places").alias("p")).select(
        "vid", "embedding", "query", "p.*"
    )


#: Queries that one task compares with a window at once.
ASKED = 8192


def _met(placed: DataFrame, total: int, queries: int, k: int, share: float, window: int) -> DataFrame:
    """query_vid, vid, score: the best k + 1 of each window that a query meets."""
    last = max(0, -(-total // window) - 1)
    around = max(1, -(-int(share * total) // (2 * window)))
    blocks = max(1, -(-queries * (2 * around + 1) // ((last + 1) * ASKED)))
    home = placed.withColumn("window", F.floor(F.col("place") / window))
    blocks_of = F.sequence(F.lit(0), F.lit(blocks - 1))
    rows = home.withColumn("block", F.explode(blocks_of)).select("ordering", "window", "block", "vid", "embedding")
    near = F.sequence(F.greatest(F.col("window") - around, F.lit(0)), F.least(F.col("window") + around, F.lit(last)))
    asking = (
        home.filter("query")
        .withColumn("window", F.explode(near))
        .withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int"))
        .select("ordering", "window", "block", "vid", "embedding")
    )

    def compare(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_vid": [], "vid": [], "score": []})
        if not len(asked) or not len(known):
            return empty
        known = known.sort_values("vid")
        vectors = np.stack(known["embedding"].to_numpy()).astype(np.float64)
        lengths, ids = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), known["vid"].to_numpy()
        out = []
        for begin in range(0, len(asked), 512):
            some = asked.iloc[begin : begin + 512]
            ours = np.stack(some["embedding"].to_numpy()).astype(np.float64)
            scores = ours @ vectors.T / lengths
            few = min(k + 1, len(ids))
            top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
            dots = np.einsum("id,ijd->ij", ours, vectors[top])
            exact = dots / (np.sqrt(np.einsum("ij,ij->i", ours, ours))[:, None] * lengths[top])
            out.append(
                pd.DataFrame({"query_vid": np.repeat(some["vid"].to_numpy(), few), "vid": ids[top].ravel(), "score": exact.ravel()})
            )
        return pd.concat(out)

    keys = ["ordering", "window", "block"]
    asking = asking.toDF(*asking.columns)  # the two sides come from one table
    found = "query_vid long, vid long, score double"
    return asking.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(compare, found)
