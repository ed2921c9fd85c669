import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from streamsync.llm import runs
from streamsync.llm.queries import repeating


def plain(words):
    """Runs by trying every period at every place: (start, length, period)."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(6, 4 * q):
                found.setdefault((begin, i + q), q)
            i += 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def texts_with_runs(seed, n):
    pick = random.Random(seed)
    for _ in range(n):
        words = [pick.randrange(pick.choice([1, 2, 3, 20])) for _ in range(pick.randint(0, 120))]
        for _ in range(pick.randint(0, 3)):
            if words:
                at, p = pick.randrange(len(words)), pick.randint(1, max(1, len(words) // 6))
                words[at : at + p] = words[at : at + p] * pick.randint(1, 9)
        yield words


def test_runs_equal_every_period_at_every_place():
    for seed in range(60):
        texts = list(texts_with_runs(seed, 5))
        bounds = np.cumsum([0, *map(len, texts)])
        start, end, period, of = runs.runs_of(np.array(sum(texts, []), np.int64), bounds)
        for i, words in enumerate(texts):
            some = of == i
            got = list(zip((start[some] - bounds[i]).tolist(), (end[some] - start[some]).tolist(), period[some].tolist()))
            assert got == plain(words), (seed, words)


def test_fibonacci_thue_morse_and_powers():
    words = [0], [0, 1]
    while len(words[1]) < 900:
        words = words[1], words[1] + words[0]
    morse = [i.bit_count() % 2 for i in range(4096)]
    for text in (words[1] * 5, morse, [0] * 5000, ([0] * 70 + [1]) * 30, [0, 1] * 3 + [0], []):
        start, end, period, _ = runs.runs_of(np.array(text, np.int64), np.array([0, len(text)]))
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == plain(text)


def test_the_grammar_derives_its_text_and_repeats_no_pair():
    for words in texts_with_runs(99, 30):
        _, own = np.unique(np.array(words, np.int64), return_inverse=True)
        grammar = runs.Grammar(own, np.zeros(len(own), np.int64))

        def whole(symbol):
            if symbol < grammar.words:
                return [symbol]
            return whole(grammar.left[symbol - grammar.words]) + whole(grammar.right[symbol - grammar.words])

        assert sum((whole(s) for s in grammar.line.tolist()), []) == own.tolist()
        pairs = [tuple(p) for p in zip(grammar.line.tolist(), grammar.line.tolist()[1:])]
        assert len({p for p in pairs if p[0] != p[1]}) == len([p for p in pairs if p[0] != p[1]])
        for symbol in range(grammar.words, grammar.words + len(grammar.left)):
            at = grammar.place[symbol - grammar.words]
            assert own[at : at + grammar.length[symbol - grammar.words]].tolist() == whole(symbol)


def expected(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    found = plain(words)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return found, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_column_of_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(runs, "WORDS", 50)  # several portions a batch
    texts = [None, "", " \t", "ha " * 9, "a b  c", "x y z " * 7 + "end", "\x1cone\x85 two\n" * 6, "A a " * 8, "word"]
    texts += [" ".join(map(str, w)) for w in texts_with_runs(4, 40)]
    given = documents([(i, t, "en", "s") for i, t in enumerate(texts)] + [(3, texts[3], "en", "s")]).withColumn("runs", F.lit(1))
    got = runs.periodic_runs(given)
    assert got.columns == [*given.columns, "runs_", "collapsed"] and got.count() == len(texts) + 1
    for r in got.withColumn("sha", runs.digest(F.col("runs_"))).withColumn("best", runs.strongest(F.col("runs_"))).collect():
        found, left = expected(texts[r.doc_id])
        assert ([tuple(x) for x in r.runs_], r.collapsed) == (found, left)
        assert r.sha == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in found).encode()).hexdigest()
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2])) if found else None
        assert (tuple(r.best) if r.best else None) == best
    assert runs.periodic_runs(given.limit(0)).count() == 0


def test_a_text_of_several_megabytes(spark, documents):
    pick = random.Random(5)
    words = [f"w{pick.randrange(5000)}" for _ in range(400_000)]
    words[100_000:100_000] = words[:50] * 40
    (row,) = runs.periodic_runs(documents([(1, " ".join(words), "en", "s")])).collect()
    assert [tuple(r) for r in row.runs] == [(100_000, 2000, 50)]
    assert row.collapsed == " ".join(words[:100_050] + words[102_000:])


def test_repeated_tails_by_hash(spark):
    from zlib import crc32

    rows = [(i, " ".join(f"{i}_{j}" for j in range(i % 37))) for i in range(300)] + [(None, "a b"), (7, None)]
    got = {(r.doc_id, r.text) for r in repeating(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = set()
    for i, text in rows:
        h = 1 if i is None else crc32(str(i).encode())
        words = (text or "").split()
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n))
        want.add((i, text))
    assert got == want
