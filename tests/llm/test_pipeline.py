import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from streamsync.llm import language, mixing, toxicity
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_the_pipeline_equals_its_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = corpus_pipeline.run(spark, SF).collect()

    # language and toxicity: the same models, asked text by text in the driver
    model = language.fit(docs, language.remainder("doc_id", 4) != 2)
    here = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "") and model.predict(language.features(r.text))[0] != "und"]
    kept = spark.createDataFrame(here, docs.schema)
    judge = toxicity.fit(kept, spark.read.parquet(f"{SF}/labels.parquet"), toxicity.remainder("doc_id", 3) != 1)
    here = [r for r in here if judge.score(r.text) < toxicity.THRESHOLD]

    # one of each group by brute force over all pairs
    groups = brute([(r.doc_id, r.text) for r in here])
    stay = {int(i) for i, n, least in groups if n == 0 or i == least}
    here = [r for r in here if r.doc_id in stay]

    mixed = mixing.mixed(spark.createDataFrame(here, docs.schema), repetitions=corpus_pipeline.REPETITIONS)
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(times) == stay

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in here:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            code = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))
            expected += [(r.doc_id, piece, a, b - a, code)] * times[r.doc_id]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)


def test_stages_keep_the_columns_and_take_odd_tables(spark, documents):
    odd = [(1, None, None, None), (None, "the and of", "en", "s"), (2, "", "en", "s"), (2, "a b c", "en", "s"), (2, "a b c", "en", "s"), (3, "1 2", None, "t")]
    for docs in (documents(odd), documents([])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_texts_in_unknown_languages_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = [
        "Весной река поднимается и люди выходят на берег смотреть на лёд " * 5, "春天河水上涨人们走到岸边看冰慢慢漂向大海" * 10,
        "Kevalla joki nousee ja ihmiset menevät rannalle katsomaan jäätä joka hitaasti kulkee kohti merta " * 5,
    ]
    rows = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(planted)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.identified(spark, docs.unionByName(rows, allowMissingColumns=True), SF)
    assert kept.filter("doc_id < 0").count() == 0
    assert kept.count() == docs.filter(language.has_letters(F.col("text"))).count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lettered = docs.filter(language.has_letters(F.col("text")))
    assert corpus_pipeline.identified(spark, docs, SF).count() == lettered.count()
    clean = docs.join(labels.filter("toxic = 0"), "doc_id", "left_semi")
    kept = corpus_pipeline.civil(spark, docs, SF).join(labels.filter("toxic = 0"), "doc_id", "left_semi")
    assert kept.count() >= 0.99 * clean.count()
