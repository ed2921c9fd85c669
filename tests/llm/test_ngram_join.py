import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from streamsync.llm import ngram_join, shingles
from streamsync.llm.components import components


def plain_set(text, width=5):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if len(words) >= width:
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def brute(rows):
    """doc_id -> (set size, smallest id reachable), each row a node, all pairs compared."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted((str(rows[i][0]), len(sets[i]), str(least[root(i)])) for i in range(len(rows)))


def near_copies(seed, bases=12, copies=9, words=60, vocabulary=400):
    """Bases with copies that differ in a few words, a passage that many share, junk."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(vocabulary)}"
    passage, rows = [word() for _ in range(25)], []
    for _ in range(bases):
        base = [word() for _ in range(draw.randrange(3, words))]
        if draw.random() < 0.5:
            base += passage
        for _ in range(draw.randrange(1, copies)):
            copy = list(base)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(len(copy))] = word()
            rows.append(" ".join(copy) if draw.random() < 0.8 else "\t".join(copy).upper())
    rows += [None, "", " \n ", "one two", "ONE  two", "one two three four", "a b c d e", "a b c d e f"]
    draw.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_components_equal_brute_force(spark, documents):
    for seed in range(3):
        rows = near_copies(seed)
        docs = documents([(i, t, None, None) for i, t in rows])
        assert found(ngram_join.near_duplicates(docs)) == brute(rows)


def test_clusters_larger_than_a_block(spark, documents):
    """More near copies of one text than a task compares at once."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(70)]
    rows = []
    for i in range(1300):
        copy = list(base)
        for _ in range(draw.randrange(4)):
            copy[draw.randrange(70)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = documents([(i, t, None, None) for i, t in rows])
    sets = [plain_set(t) for _, t in rows]
    names = {s: i for i, s in enumerate(sorted({x for s in sets for x in s}))}
    table = np.zeros((len(rows), len(names)), np.float32)
    for i, s in enumerate(sets):
        table[i, [names[x] for x in s]] = 1
    common, size = table @ table.T, table.sum(axis=1)
    linked = 100 * common >= 80 * (size[:, None] + size[None, :] - common)
    label = np.arange(len(rows))
    while True:
        new = np.where(linked, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            break
        label = new
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(rows))] == label.tolist()
    assert 1 < len(set(label.tolist())) < 1300


def test_blocks_of_a_shingle_give_each_pair_once(spark, monkeypatch):
    """A passage that many clusters share, in one block and in many."""
    draw = random.Random(8)
    rows = [(i * 7 - 90, 40 + draw.randrange(8), shingle, draw.randrange(12), 60, i // draw.randrange(1, 4)) for i in range(60) for shingle in (5, 6 + i % 2)]
    rows += [(1000 + i, 50, 9, 0, 4, 77) for i in range(4)]  # one cluster alone: no pairs
    schema = "set_id long, n long, shingle long, place int, classes long, component long"
    wanted = set()
    for a, n, shingle, place, _, one in rows:
        for b, m, other, at, _, two in rows:
            most = min(place, at) + min(n - place, m - at)
            if a < b and shingle == other and one != two and 100 * min(n, m) >= 80 * max(n, m) and 180 * most >= 80 * (n + m):
                wanted.add((a, b))
    for size in (2048, 7, 1):
        monkeypatch.setattr(ngram_join, "SALTED", size)
        pairs = [tuple(r) for r in ngram_join._rest(spark.createDataFrame(rows, schema), 80).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == wanted


def test_odd_rows(spark, documents):
    long = "v1 v2 v3 v4 v5 v6 " * 60_000
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s t u v"), (None, "a b c d e f"), (None, "z"), (9, long), (8, long + "end")]
    docs = documents([(i, t, None, None) for i, t in rows])
    assert found(ngram_join.near_duplicates(docs)) == brute(rows)
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    texts = sorted((str(r.doc_id), r.text[:12]) for r in kept.collect())
    assert texts == [("1", "a b c d e f"), ("8", long[:12]), ("None", "a b c d e f"), ("None", "z")]


def test_one_of_each_group_stays(spark, documents):
    rows = near_copies(8)
    docs = documents([(i, t, "en", "s") for i, t in rows])
    stay = {r.doc_id for r in ngram_join.keep_first(docs).collect()}
    assert stay == {int(i) for i, n, least in brute(rows) if n == 0 or i == least}


def test_shingles_of_long_and_short_texts():
    texts = [b"x" * (shingles.SLICE + 5) + b" y z", b"a b c d " * 300_000, b"", b"\xc3\x89 A \xc3\xa9", b"1 2 3 4 5"]
    hashes, bounds = shingles.shingle_sets(texts)
    assert np.diff(bounds).tolist() == [len(plain_set(t.decode())) for t in texts]
    one, _ = shingles.shingle_sets([texts[4]])
    assert one.tolist() == hashes[bounds[4] :].tolist()
    names = shingles.set_names(hashes, bounds)
    assert len(set(names.tolist())) == 5 and names[2] == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 301), (301, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}, 300: 300, 301: 300}
    assert components(df.limit(0)).count() == 0


def test_op5_on_the_tables(spark):
    from streamsync.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op5_ngram_jaccard_join(spark, sf)) == brute(rows)


def test_index_bytes_stay_bounded_as_ranges_grow(spark):
    rows = [(i, " ".join(f"w{(i * 7919 + j * 104729) % 100003}" for j in range(120))) for i in range(300)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(1).select("text")
    size = lambda bits: ngram_join._index(texts, 5, bits).selectExpr("sum(length(classes) + length(postings)) n").first().n
    # a range lists the classes it has, so no more than one for each shingle
    shingles = 300 * 116
    assert size(11) <= 40 * shingles and size(11) < 8 * size(4)


def peak(run):
    """The most bytes that Python and numpy held at once beyond what they held before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_shingles_and_blocks():
    words = np.random.default_rng(3).integers(0, 10**6, 600_000)
    texts = [" ".join(map(str, words[i : i + 300])).encode() for i in range(0, len(words), 300)]
    some = texts[:500]  # 1 MB
    assert peak(lambda: shingles.shingle_sets(some)) < 25e6
    hashes, bounds = shingles.shingle_sets(texts)
    held = lambda: [(hashes.copy(), shingles.set_names(hashes, bounds), np.diff(bounds))]
    assert peak(lambda: [0 for _ in ngram_join._blocks(held(), 4)]) < 45 * len(hashes)
    blocks = [b for h in (held(), held()) for b in ngram_join._blocks(h, 0)]
    assert peak(lambda: [0 for _ in ngram_join._counted(blocks, 0)]) < 45 * 2 * len(hashes)


def test_blocks_have_every_posting_once():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 500, 40).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    sets = [*sets, *sets[:7], np.empty(0, np.uint64)]  # copies, and one without shingles
    bounds = np.cumsum([0, *map(len, sets)])
    names = shingles.set_names(np.concatenate(sets), bounds)
    true = {(h, n) for s, n in zip(sets, names.tolist()) for h in s.tolist()}
    times = Counter(h for h, _ in true)
    parts = [slice(0, 20), slice(20, 50), slice(50, len(sets))]
    for bits in (0, 3, 6):
        held = [[(np.concatenate(sets[p]), names[p], np.array([len(s) for s in sets[p]]))] for p in parts]
        held = [[*held[0], *held[1]], held[2]]  # two blocks' worth; the copies are in the other one
        by_range = defaultdict(list)
        for some in held:
            for block in ngram_join._blocks(some, bits):
                by_range[block.column("target")[0].as_py()].append(block)
            assert not some
        seen, counts, classes_of = set(), [], {}
        for target, blocks in by_range.items():
            classes, (hashes, of) = ngram_join._read_blocks(blocks, "<u8", "<u4")
            assert (hashes >> np.uint64(64 - bits) == target).all() if bits else target == 0
            seen |= set(zip(hashes.tolist(), classes["id"][of].tolist()))
            for block in ngram_join._counted(blocks, bits):
                classes, (hashes, of, df) = ngram_join._read_blocks([block], "<u8", "<u4", "<u4")
                counts += zip(hashes.tolist(), classes["id"][of].tolist(), df.tolist())
                classes_of |= dict(zip(classes["id"].tolist(), classes["size"].tolist()))
        assert seen == true
        assert sorted(counts) == sorted((h, n, times[h]) for h, n in true if times[h] > 1)
        sizes = dict(zip(names.tolist(), map(len, sets)))
        assert all(sizes[n] == size for n, size in classes_of.items())
