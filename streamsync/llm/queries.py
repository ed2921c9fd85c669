"""The registered queries of this folder: name -> (query, oracle SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.llm import (
    conversations,
    fingerprints,
    hosts,
    language,
    mixing,
    neighbours,
    ngram_join,
    packing,
    runs,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from streamsync.llm.common import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return toxicity.score_documents(table(spark, sf_dir, "documents"), labels)


#: The rules of the fourth query: (verdict, host and path).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"), RULES)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP7_WARC = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) n, sha1(coalesce(html, '')) d from pages),
g as (select d, max(page_id) keeper from p where n >= 1000 group by d)
select page_id, n::bigint payload_bytes, d payload_digest,
  case when keeper <> page_id then 'revisit' else 'response' end record_type,
  case when keeper <> page_id then keeper end refers_to
from p left join g using (d)"""


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors.withColumn("query", F.col("vec_id") % 50 == 0), k=5)


#: No source is passed over more than so often as the least repeated one.
REPETITIONS = 1.5


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; its text stays out of the result."""
    mix = mixing.mixed(table(spark, sf_dir, "documents"), repetitions=REPETITIONS)
    return mix.drop("text", "n_chars")


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten repeats a stretch of its words to its end."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, at(i).cast("int"))), " ")

    # the words are a lambda's variable, so that they are taken once a text
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    chosen = (hashed % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    text = F.when(chosen, F.get(F.transform(words, repeated), F.lit(0))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(repeating(table(spark, sf_dir, "documents")))
    best = runs.strongest(F.col("runs"))
    with_best = found.withColumn("best", best)
    return with_best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        runs.digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with faults: a message is dropped, emptied, left without the ends of
    its sentences, repeated or given to the user, by a hash of its conversation and turn."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = spaced
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    bad = rows.filter(fault != 0).select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return bad.drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    report = conversations.audit(rows, every=given)
    hashes = conversations.digests(conversations.repaired(rows, report)).withColumnRenamed("conv_id", "of")
    both = report.join(hashes, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    empty = F.sha2(F.lit(""), 256)
    return both.drop("of", "slots").withColumn("repaired_sha256", F.coalesce("sha256", empty)).drop("sha256")


QUERIES = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_language_id": (op2_language_id, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_url_filter": (op4_url_filter, None),
    "op5_ngram_jaccard_join": (op5_ngram_jaccard_join, None),
    "op6_token_counts": (op6_token_counts, None),
    "op7_warc": (op7_warc, OP7_WARC),
    "op8_fingerprints": (op8_fingerprints, None),
    "op9_nearest_neighbours": (op9_nearest_neighbours, None),
    "op10_source_mixing": (op10_source_mixing, None),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_simhash_near_dedup": (op12_simhash_near_dedup, None),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
