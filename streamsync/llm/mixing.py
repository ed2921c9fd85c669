"""Temperature mixing of sources, in DataFrame operations only.

A source with share p of all tokens gets weight p^a / sum of p^a.  The exponent a is
bisected until the weights' entropy is the wanted one, or until no source is passed over
too often.  The weights then become token budgets, and each source is a row of blocks:
every block is a permutation of the whole source, the last one cut where the budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamsync.llm.common import free_name, stored

#: Exponents tried in one pass over the sources (31: five halvings), and passes.
GRID, PASSES = 31, 8
#: Bits of a block's order that one pass settles; LEVELS passes settle all of them.
BITS, LEVELS = 12, 5


def words(text: Column) -> Column:
    """Tokens of a text by white space; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent(
    shares: DataFrame,
    entropy: float | None = None,
    repetitions: float | None = None,
    passes: float | None = None,
) -> float:
    """The exponent from 0 to 1 that meets the wish; ``shares`` has ``share`` over 0, one a source.

    With ``entropy`` (nats), the largest exponent whose weights have no less; 0 if none has.
    With ``repetitions``, the least exponent at which no source is passed over more than so
    often; 1 if none is.  The mix then has ``passes`` times the tokens of the sources, or by
    default as many as pass over the least repeated source once.
    """
    if (entropy is None) == (repetitions is None):
        raise ValueError("give either a target entropy or a repetition limit")
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / (GRID + 1)
        tried = F.array(*[F.lit(low + step * i) for i in range(GRID + 2)])
        power = F.pow("share", "a")
        sums = (
            shares.select("share", F.explode(tried).alias("a"))
            .groupBy("a")
            .agg(
                F.sum(power).alias("z"),
                F.sum(power * F.ln("share")).alias("logs"),
                F.min("share").alias("least"),
                F.max("share").alias("most"),
            )
        )
        if entropy is not None:
            short = F.ln("z") - F.col("a") * F.col("logs") / F.col("z") < entropy
        elif passes is None:
            short = F.pow(F.col("most") / F.col("least"), 1 - F.col("a")) <= repetitions
        else:
            short = passes * F.pow("least", F.col("a") - 1) / F.col("z") <= repetitions
        rows = sums.select("a", short.alias("high")).collect()  # GRID + 2 rows
        if not rows:
            return 1.0
        high = min((r["a"] for r in rows if r["high"]), default=1.0)
        low = max((r["a"] for r in rows if not r["high"] and r["a"] <= high), default=low)
        if high <= low:
            break
    return low if entropy is not None else high


def _draw(row: Column, epoch: Column, seed: int) -> Column:
    """The place of a row in a block's permutation: BITS * LEVELS bits."""
    return F.shiftrightunsigned(F.xxhash64(row, epoch, F.lit(seed)), 64 - BITS * LEVELS)


def _cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, bound, copies: the cut block has what is drawn below ``bound``, and of the
    equal rows drawn there so many copies.

    The bound is found BITS at a time: the tokens of each run of draws are summed, and
    only the run in which the budget ends is looked at further.  No task orders a source.
    """
    found = budgets.filter("rest > 0").select(
        F.col("source").alias("cut_source"), F.lit(0).cast("long").alias("bound"), F.col("rest")
    )
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        run = F.shiftright("draw", shift)
        inside = (F.col("source") == F.col("cut_source")) & (F.shiftright(run, BITS) == F.col("bound"))
        sums = (
            rows.join(found, inside)
            .groupBy("cut_source", run.alias("run"))
            .agg(F.sum("tokens").alias("tokens"), F.max("tokens").alias("each"), F.first("rest").alias("rest"))
        )
        before = Window.partitionBy("cut_source").orderBy("run")  # 2 ** BITS rows at most
        ended = sums.withColumn("upto", F.sum("tokens").over(before)).filter("upto > rest")
        found = stored(
            ended.groupBy("cut_source").agg(
                F.min_by(F.struct("run", F.expr("rest - upto + tokens").alias("left"), "each"), "run").alias("c")
            ).select("cut_source", F.col("c.run").alias("bound"), F.col("c.left").alias("rest"), "c.each"),
            "cut",
        )
    return found.select("cut_source", "bound", F.floor(F.col("rest") / F.col("each")).alias("copies"))


def mixed(
    docs: DataFrame,
    entropy: float | None = None,
    repetitions: float | None = None,
    budget: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Every row as often as the mix takes it, with n_tokens, epoch, block_key, mix_key,
    weight, budget_tokens and source_tokens after its columns (clashing names get ``_``).

    Without ``budget`` the mix is the smallest one that passes over every source at least
    once, so no row is lost.  Rows go by block_key within a block, a random permutation;
    over all sources mix_key, from 0 to 1, interleaves them at their weights.  A null
    source is a source; a source without any token has weight 0 and is passed over once.
    Equal rows are drawn together and count each for itself.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    added = "n_tokens epoch block_key mix_key weight budget_tokens source_tokens".split()
    names = [free_name(docs, n) for n in added]
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    one = docs.select(
        F.struct(*own).alias("own"), source.alias("source"), words(F.col("text").cast("string")).alias("tokens"),
        F.xxhash64(*own).alias("row"),
    )
    rows = stored(one.select("source", "tokens", "row"), "mix-rows")
    totals = stored(rows.groupBy("source").agg(F.sum("tokens").alias("total")), "mix-sources")
    everything = totals.agg(F.sum("total")).first()[0] or 0
    shares = totals.filter("total > 0").withColumn("share", F.col("total") / F.lit(float(everything or 1)))
    passes = budget / everything if budget is not None and everything else None
    a = exponent(shares.select("share"), entropy, repetitions, passes)
    power = F.pow("share", F.lit(a))
    z, widest = shares.agg(F.sum(power), F.max(F.col("total") / power)).first()
    wanted_all = float(budget) if budget is not None else (z or 0.0) * (widest or 0.0)

    weight = F.when(F.col("total") > 0, F.pow(F.col("total") / F.lit(float(everything or 1)), F.lit(a)) / F.lit(z or 1.0))
    exact = F.col("weight") * F.lit(wanted_all)
    # a whole number of passes shall not miss a token by rounding
    whole = F.round(exact / F.col("total"))
    near = F.abs(exact / F.col("total") - whole) < 1e-9
    wanted = F.when(F.col("total") == 0, 0).when(near, whole * F.col("total")).otherwise(F.floor(exact))
    budgets = stored(
        totals.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
        .withColumn("wanted", wanted.cast("long"))
        .withColumn("whole", F.when(F.col("total") > 0, F.floor(F.col("wanted") / F.col("total"))).otherwise(1).cast("long"))
        .withColumn("rest", F.when(F.col("total") > 0, F.col("wanted") % F.col("total")).otherwise(0).cast("long")),
        "mix-budgets",
    )
    of_cut = budgets.select(F.col("source").alias("of"), "whole")
    drawn = rows.join(of_cut, F.col("source") == F.col("of")).select(
        "source", "tokens", _draw(F.col("row"), F.col("whole"), seed).alias("draw")
    )
    plan = budgets.join(_cuts(drawn, budgets), F.col("source") == F.col("cut_source"), "left")
    plan = stored(plan.drop("cut_source").withColumnRenamed("source", "of"), "mix-plan")  # one row a source

    blocks = one.join(plan, F.col("source") == F.col("of")).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))
    ).withColumn("draw", _draw(F.col("row"), F.col("epoch"), seed))
    taken = blocks.filter((F.col("epoch") < F.col("whole")) | (F.col("draw") < F.col("bound")))
    # of the equal rows at the bound some copies only
    edge = blocks.filter((F.col("epoch") == F.col("whole")) & (F.col("draw") == F.col("bound")) & (F.col("copies") > 0))
    edge = edge.groupBy(*[c for c in edge.columns]).agg(F.count("*").alias("n"))
    edge = edge.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", "copies"))))
    both = taken.unionByName(edge.select(*taken.columns))
    space = float(1 << (BITS * LEVELS))
    along = (F.col("epoch") + F.col("draw") / space) * F.col("total") / F.col("wanted")
    mix_key = F.when(F.col("wanted") > 0, F.least(along, F.lit(1.0))).otherwise(F.col("draw") / space)
    values = ["tokens", F.col("epoch").cast("int"), "draw", mix_key, "weight", "wanted", "total"]
    return both.select(
        "own.*", *[(F.col(v) if isinstance(v, str) else v).alias(n) for v, n in zip(values, names)]
    )


def mixed_documents(docs: DataFrame, **wish) -> DataFrame:
    """The rows of the mix with the columns of the documents alone."""
    return mixed(docs, **wish).select(*[F.col(f"`{c}`") for c in docs.columns])
