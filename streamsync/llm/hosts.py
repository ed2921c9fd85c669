"""URL filter by rules, and by trust that flows along the links between hosts.

A page's links make edges from its host to others.  Two personalised PageRanks run over
them together: trust starts at the hosts of pages that a rule allows and follows the
links; distrust starts at the hosts of pages that a rule blocks and follows them
backwards, to whoever links there.  A page without a rule of its own is judged by its
host's two ranks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import stored
from streamsync.scratch import file_system, work_dir

#: Share of a rank that moves along the links; change of all ranks at which the rounds end.
DAMPING, SETTLED = 0.85, 1e-4
#: Edges of one host that one task joins.
EDGES = 100_000
#: A host with more than one part in HOT of the pages is dealt to as many tasks; so fewer
#: than HOT hosts are.
HOT = 500


def url_host(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, null if none does.

    Of rules of one length the one last by name wins.  ``rules`` are (verdict, host and
    path); the list is a parameter of the job and part of its plan, thousands at most.
    """
    by_host: dict[str, list[Column]] = {}
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        entry = F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"),
            F.lit(slash + rest).alias("path"),
        )
        by_host.setdefault(name.lower(), []).append(entry)
    if not by_host:
        return F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    known = F.create_map(*[x for n, own in by_host.items() for x in (F.lit(n), F.array(*own))])
    labels = F.split(host, r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    of_tails = F.flatten(F.transform(tails, lambda t: F.coalesce(F.try_element_at(known, t), F.array().cast("array<struct<size: int, rule: string, verdict: string, path: string>>"))))
    return F.array_max(F.filter(of_tails, lambda r: F.startswith(path, r["path"])))


def links(pages: DataFrame) -> DataFrame:
    """from_host, to_host, n: how often pages of one host link to another one."""
    target = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
    found = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(target), 1)).alias("to"))
    to = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))
    return (
        found.select(F.col("host").alias("from_host"), url_host(to).alias("to_host"))
        .filter("from_host <> '' and to_host <> '' and from_host <> to_host")
        .groupBy("from_host", "to_host")
        .agg(F.count("*").alias("n"))
    )


def ranks(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, settled: float = SETTLED) -> DataFrame:
    """kind, host, rank of two personalised PageRanks; ``seeds`` are kind, host, pages.

    Of kind ``trust`` rank follows the edges, of ``distrust`` it goes back along them.
    The seeds of each kind share 1 in the proportion of their pages, and what reaches a
    host without edges returns to them.  Only hosts with some rank have a row.

    Rounds go on until all ranks together change by less than ``settled``.  Each change is
    at most DAMPING times the one before and the first at most 4, which bounds the rounds;
    ``rounds`` ends them sooner.
    """
    spark = edges.sparkSession
    both = edges.select(F.lit("trust").alias("kind"), F.col("from_host").alias("src"), F.col("to_host").alias("dst"), "n").union(
        edges.select(F.lit("distrust"), "to_host", "from_host", "n")
    )
    sizes = stored(
        both.groupBy(F.col("kind").alias("k"), F.col("src").alias("s"))
        .agg(F.sum("n").alias("all"), F.ceil(F.count("*") / EDGES).cast("int").alias("blocks")),
        "host-sizes",
    )
    steps = stored(
        both.join(sizes, (F.col("kind") == F.col("k")) & (F.col("src") == F.col("s"))).select(
            "kind", "src", "dst", (F.col("n") / F.col("all")).alias("part"),
            F.pmod(F.xxhash64("dst"), "blocks").cast("int").alias("block"),
        ),
        "host-edges",
    )
    wide = sizes.filter("blocks > 1").drop("all")  # hosts that link to very many others
    of_kind = seeds.groupBy(F.col("kind").alias("k")).agg(F.sum("pages").alias("all"))  # two rows
    start = stored(
        seeds.join(F.broadcast(of_kind), F.col("kind") == F.col("k"))
        .select("kind", "host", (F.col("pages") / F.col("all")).alias("start")),
        "host-seeds",
    )
    rank = start.withColumnRenamed("start", "rank")
    folder = work_dir(spark, "host-rounds")
    most = math.ceil(math.log(settled / 4, DAMPING)) + 1 if rounds is None else rounds
    for i in range(most):
        dealt = rank.join(wide, (F.col("kind") == F.col("k")) & (F.col("host") == F.col("s")), "left").select(
            F.col("kind").alias("of"), "host", "rank",
            F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("at"),
        )
        moved = (
            dealt.join(steps, (F.col("kind") == F.col("of")) & (F.col("src") == F.col("host")) & (F.col("block") == F.col("at")))
            .groupBy("kind", F.col("dst").alias("host"))
            .agg((DAMPING * F.sum(F.col("rank") * F.col("part"))).alias("gain"))
        )
        parts = moved.select("kind", "host", "gain", F.lit(0.0).alias("start"), F.lit(0.0).alias("old"))
        parts = parts.union(start.select("kind", "host", F.lit(0.0), "start", F.lit(0.0)))
        parts = parts.union(rank.select("kind", "host", F.lit(0.0), F.lit(0.0), "rank"))
        summed = parts.groupBy("kind", "host").agg(
            F.sum("gain").alias("gain"), F.sum("start").alias("start"), F.sum("old").alias("old")
        )
        summed.write.parquet(f"{folder}/{i}")
        summed = spark.read.schema(summed.schema).parquet(f"{folder}/{i}")
        got = summed.groupBy(F.col("kind").alias("k")).agg(F.sum("gain").alias("got"))  # two rows
        new = summed.join(F.broadcast(got), F.col("kind") == F.col("k")).withColumn(
            "rank", F.col("gain") + F.col("start") * (1 - F.col("got"))
        )
        rank = new.select("kind", "host", "rank").filter("rank > 0")
        change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
        if i:  # nothing reads the round before any more
            fs, place = file_system(spark, f"{folder}/{i - 1}")
            fs.delete(place, True)
        if change < settled:
            return rank
    if rounds is None:
        raise RuntimeError(f"the ranks still change by {change} after {most} rounds")
    return rank


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], threshold: float = 0.5, default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row.

    A null url, or one without ``://``, has an empty host and path, which no rule fits.
    Without a rule, a page is blocked if more than ``threshold`` of its host's two ranks,
    each weighed by its seeds' pages, is distrust; a host that no rank reaches before they
    settle has the ``default``.  Repeated rows each give a row; other columns are not looked at.
    """
    parsed = pages.select("page_id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    found = best_rule(F.col("host"), F.col("path"), rules)
    ruled = stored(
        parsed.withColumn("found", F.when(F.col("host") != "", found)).select(
            "page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled")
        ),
        "ruled-pages",
    )
    seeds = (
        ruled.filter("rule is not null")
        .groupBy(F.when(F.col("ruled") == "block", "distrust").otherwise("trust").alias("kind"), "host")
        .agg(F.count("*").alias("pages"))
    )
    rank = ranks(links(parsed.select("host", "html")), seeds)
    per_host = rank.groupBy(F.col("host").alias("ranked")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    joined = _of_hosts(ruled, stored(per_host, "host-ranks"))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_rank = F.when(trust + distrust == 0, default).when(distrust > threshold * (trust + distrust), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_rank).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )


def _of_hosts(pages: DataFrame, per_host: DataFrame) -> DataFrame:
    """The rows of ``pages``, each with those of ``per_host`` (by ``ranked``) if there are.

    The pages of a hot host are dealt to several tasks, each with a copy of the host's row.
    """
    total = pages.count()
    sizes = pages.groupBy(F.col("host").alias("hot")).agg((F.count("*") * HOT / max(total, 1)).alias("share"))
    hot = stored(sizes.filter("share > 1").select("hot", F.ceil("share").cast("int").alias("blocks")), "hot-hosts")
    small = F.broadcast(hot)  # fewer than HOT rows
    one = F.lit(1)
    dealt = pages.join(small, F.col("host") == F.col("hot"), "left").withColumn(
        "block", F.pmod(F.xxhash64("page_id", "path"), F.coalesce("blocks", one)).cast("int")
    )
    copies = per_host.join(small, F.col("ranked") == F.col("hot"), "left").select(
        "ranked", "trust", "distrust", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", one) - 1)).alias("copy")
    )
    return dealt.join(copies, (F.col("host") == F.col("ranked")) & (F.col("block") == F.col("copy")), "left")
