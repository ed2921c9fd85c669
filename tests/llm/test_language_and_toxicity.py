import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest

from streamsync.llm import language, linear, toxicity

SF = "/root/testdata/sf0.1"


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_machine_separates_what_can_be_separated():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(400, 30))
    labels = rows @ draw.normal(size=30) > 0.3
    weights, bias = linear.train_svm(rows, labels, penalty=1000)
    assert (((rows @ weights + bias) > 0) == labels).mean() > 0.99
    weights, bias = linear.train_svm(rows, np.ones(400, bool))
    assert bias == 1 and not weights.any()
    scale, shift = linear.fit_logistic(np.array([-2.0, -1, 1, 2]), np.array([False, False, True, True]))
    assert scale > 0 and abs(shift) < 0.5


def test_features_see_whole_texts():
    long = "ab " * 500_000
    assert np.allclose(language.features(long + "zzz" * 10_000), language.features(long + "zzz" * 10_000))
    assert not np.allclose(language.features(long), language.features(long + "zzz" * 10_000))
    assert not language.features("12 34 !?").any() and not language.features("").any()


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.identify(docs).collect()
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(true) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) for r in rows)
    judged = [r for r in rows if r.held_out and true[r.doc_id]]
    assert np.mean([r.lang_pred == true[r.doc_id] for r in judged]) > 0.98


def sample(documents):
    words = {"en": "the and of", "de": "der und ich", "fr": "les est une", "xx": "qq ww kk"}
    rows = [(i, f"{words[k]} {words[k][i % 5]} {words[k]}", k, "s") for i, k in enumerate(list(words) * 12)]
    odd = [
        (900, None, "en", None), (901, "", "de", None), (902, "123 !!", "fr", "s"), (None, "the and of the", None, "s"),
        (903, "und der und", None, None), (903, "und der und", None, None), (904, "the of " * 200_000, "en", "s"),
    ]
    return documents(rows + odd)


def test_languages_of_odd_rows(spark, documents):
    docs = sample(documents)
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: (r.lang_pred, r.held_out) for r in rows}
    assert [found[i][0] for i in (900, 901, 902, 903, 904, None)] == ["und", "und", "und", "de", "en", "en"]
    assert found[None][1] is False
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert language.identify(docs.limit(0)).count() == 0
    unknown = language.identify(docs.filter("lang is null")).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_family_comes_first(spark, documents):
    model = language.fit(sample(documents), language.F.lit(True))
    assert model.members == {"germanic": ["de", "en"], "romance": ["fr"], "xx": ["xx"]}
    assert list(model.pairs) == [("de", "en")]


def own_signs(i, n=12):
    return " ".join(chr(0x4E00 + 40 * i + k) * 2 for k in range(n))


def test_every_labelled_row_is_learned(spark, documents):
    # no two texts share a character, so a row that was left out would be a guess
    rows = [(i, own_signs(i), ("xx", "yy")[i % 2], "s") for i in range(48)] + [(48, own_signs(48), "zz", "s")]
    docs = documents(rows + rows[:6])
    dealt, languages = language.dealt(docs, per_language=4)
    found = dealt.collect()
    assert languages == ["xx", "yy", "zz"] and len({r.hashed for r in found}) == 49
    sizes = {g: sum(r.group == g for r in found) for g in {r.group for r in found}}
    assert len(sizes) >= 4 and {r.group for r in found if r.lang == "zz"} == set(sizes)
    model = language.fit(docs, language.F.lit(True), per_language=4)
    right = [model.predict(language.features(text))[0] == lang for _, text, lang, _ in rows]
    assert sum(right) >= 45


def test_threshold_counts_every_held_out_row(spark, documents):
    docs = sample(documents).filter("doc_id < 900")
    model = language.fit(docs, language.F.lit(True))
    scores = [model.predict(language.features(r.text))[1] for r in docs.collect()]
    low = [(1000, "the of " + "qq ww kk " * 3, "xx", "s")]
    below = model.predict(language.features(low[0][1]))[1]
    assert below < min(scores) and model.predict(language.features(low[0][1]))[0] == "xx"
    many = docs.unionByName(documents(low))
    least = language.least_score(many, language.F.lit(True), model)
    assert least == pytest.approx(max(0, min(language.LEAST, below - language.BELOW)), abs=2e-5)


@pytest.fixture(scope="module")
def learned():
    good = [f"a quiet text about the weather number {w} and rivers" for w in "one two three four five six seven eight nine ten".split() * 30]
    good = [g + f" {i * 7919 % 1000}x" for i, g in enumerate(good)]
    bad = [f"{g} {w}" for g, w in zip(good, ["blighter", "scallywag", "numbskull"] * 100)]
    return toxicity.learn(good + bad, [0] * len(good) + [1] * len(bad))


@pytest.mark.parametrize(
    "text", ["blighter", "You BLIGHTER!", "b l i g h t e r", "bli-ghter", "b.l.i.g.h.t.e.r", "numbsskull", "scally wag scallywag"]
)
def test_insults_with_gaps(learned, text):
    assert learned.score("such a nice day, " + text + " and more") >= 0.7


@pytest.mark.parametrize(
    "text", ["well,blighter", "you-blighter", "a/blighter/b", "sir\u2014blighter", "theweatherandtheriversareq" + "blighter" + "uietaboutthenumberoneortwoxx"]
)
def test_insults_within_words(learned, text):
    assert learned.score("such a nice day, " + text + " and more") >= 0.7
    assert learned.score("such a nice day, " + text.replace("blighter", "rivers") + " and more") < 0.5


def test_pieces_and_windows_score_as_units_of_their_own():
    draw = np.random.default_rng(2)
    table = draw.normal(size=1 << toxicity.RUN_BITS).astype(np.float32)
    word, short = "abcdefghijklmnopqr", "zyxwvutsrqponml"
    pieces = [w[i : i + n] for w in (word, short) for n in toxicity.PIECES for i in range(len(w) - n + 1)]
    got = toxicity.pieces_worst(toxicity.long_words(toxicity.encode(f"some {word} and {short}")), table, 0.5)
    assert abs(got - toxicity.decisions(toxicity.coded(pieces), table, 0.5).max()) < 1e-3
    words = "it is a b of plain words here".split()
    windows = [" ".join(words[i : i + n]) for n in toxicity.WINDOWS for i in range(len(words) - n + 1)]
    got = toxicity.windows_worst(toxicity.encode(" ".join(words)), table, 0.5)
    assert abs(got - toxicity.decisions(toxicity.coded(windows), table, 0.5).max()) < 1e-3


def test_phrases_of_ordinary_words():
    draw = np.random.default_rng(5)
    plain = "quiet weather number rivers people house green morning table window people empty head garden".split()
    lines = [[plain[i] for i in draw.integers(0, len(plain), 12)] for _ in range(600)]
    lines = [t for t in lines if ("empty", "head") not in zip(t, t[1:])]
    bad = [[*t[:6], "empty", "head", *t[6:]] for t in lines[:200]]
    texts, labels = [" ".join(t) for t in lines + bad], [0] * len(lines) + [1] * len(bad)
    model = toxicity.learn(texts, labels)
    assert model.score("green morning empty head by the rivers") >= 0.7
    assert model.score("green morning. Empty-head, people") >= 0.7
    assert model.score("empty house people head morning") < 0.5 and model.score("head empty garden table") < 0.5


def test_clean_texts(learned):
    for text in ("", None, "!!! ???", "the weather is fine", "light and bright", "x" * 300_000, "rivers " * 60_000):
        assert learned.score(text) < 0.5
    assert learned.score("the weather " * 60_000 + "blighter") >= 0.7


def test_the_folded_table_is_the_kernel_machine():
    good, bad = ["weather", "rivers", "quiet", "about"], ["blighter", "numbskull"]
    machine = toxicity._Machine(good, bad, [1.0, 1.0], sorted(good + bad))
    known = toxicity._columns(sorted(good + bad))
    words = ["blightr", "weathers", "skull", "q"]
    marks = np.zeros((known.max() + 1, 6), np.float32)
    word, column, value = toxicity._sparse(sorted(good + bad), known)
    np.add.at(marks, (column, word), value)
    dense = toxicity._kernel(words, known, marks)
    values, vectors = np.linalg.eigh(marks.T @ marks)
    assert dense.shape == (4, 6) and not dense[3].any() and values.min() > 0
    code = toxicity.encode(" ".join(words))
    begins, ends = toxicity.spans(code)
    for i, w in enumerate(words):  # a plain kernel: sum over runs of products of weights
        def profile(text):
            one = toxicity.encode(text)
            out = {}
            for _, what, weight in toxicity.runs(one, *toxicity.spans(one)):
                for u in what.tolist():
                    out[u] = out.get(u, 0) + weight
            size = toxicity._ends_norm(one, np.diff(np.array(toxicity.spans(one)), axis=0)[0], toxicity.spans(one)[1]).sum()
            return out, max(size, 1.0) ** 0.5

        mine, size = profile(w)
        for j, m in enumerate(sorted(good + bad)):
            theirs, other = profile(m)
            plain = sum(v * theirs.get(u, 0) for u, v in mine.items()) / size / other
            assert abs(plain - dense[i, j]) < 1e-4


def test_one_label_only():
    assert toxicity.learn(["a b"], [0]).score("anything") < 0.01
    assert toxicity.learn(["a b"], [1]).score("anything") > 0.99
    assert toxicity.learn([], []).score("anything") < 0.01


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_documents(docs, labels).collect()
    true = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == held_out(r.doc_id, 3, 1) and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(r.predicted, true[r.doc_id]) for r in rows if r.held_out and r.doc_id in true]
    hit = sum(p and t for p, t in judged)
    assert hit / sum(t for _, t in judged) > 0.7 and hit / sum(p for p, _ in judged) > 0.9


def test_toxicity_of_odd_rows(spark, documents):
    docs = documents([(1, None, None, None), (2, "", "en", "s"), (None, "some words", "en", "s"), (1, "a b", None, "s")])
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 0), (None, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == 4 and all(r.score < 0.7 and r.predicted == 0 for r in rows)
    kept = toxicity.keep_civil(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_a_finished_task_keeps_no_tokens():
    model = toxicity.learn(["you are a blorf", "blorf again", "blorf you"] * 4 + [f"fine day {i}" for i in range(40)], [1] * 12 + [0] * 40)
    texts = [pd.Series(["a blorf", None]), pd.Series(["some other words"])]
    got = [x for batch in toxicity.judged(iter(texts), model) for x in batch]
    assert got == model.scores(["a blorf", None, "some other words"])
    list(toxicity.judged(iter(texts), model))
    assert not model.known


def test_memory_of_a_machine():
    draw = np.random.default_rng(6)
    words = ["".join(map(chr, draw.integers(97, 123, 12))) for _ in range(4000)]
    runs = toxicity._columns(sorted(words[:800])).max() + 1
    tracemalloc.start()
    try:
        toxicity._Machine(words[400:], words[:400], [1.0] * 400, sorted(words[:800]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 * 800 * int(runs) + 60e6  # the landmarks' runs, and little with them
