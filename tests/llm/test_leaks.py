import random

import numpy as np

from edge import documents
from triad.llm import leaks as L

SMALL = "/root/testdata/sf0.001"


def slow_tiles(doc, item, n):
    """Words covered by greedy string tiling in the plainest way."""
    in_doc, in_item, out = set(), set(), []
    while True:
        best = (n - 1, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while (i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k]
                       and i + k not in in_item and d + k not in in_doc):
                    k += 1
                if k > best[0]:
                    best = (k, i, d)
        k, i, d = best
        if k < n:
            return sorted(out)
        out.append((d, i, k))
        in_item.update(range(i, i + k))
        in_doc.update(range(d, d + k))


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    p = L.Tiling(seed=3, percent=1)
    for _ in range(300):
        item = [rng.choice("abcd") for _ in range(rng.randint(3, 18))]
        doc = [rng.choice("abcde") for _ in range(rng.randint(0, 40))]
        cut = rng.randint(0, len(item))
        doc[5:5] = item[cut:] + ["q"] + item[:cut]
        index = L.Index([(1, item)], p)
        found = index.leaks(doc)
        want = slow_tiles(doc, item, 3)
        assert (found[0][4] if found else []) == want


def test_common_seeds_do_not_hide_a_leak():
    """Pruning by rare seeds finds what tiling every item finds."""
    rng = random.Random(8)
    phrase = "answer the following question in one short and plain sentence".split()
    items = [(k, phrase + [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(3, 30))]) for k in range(60)]
    p = L.Tiling()
    index = L.Index(items, p)
    for _ in range(40):
        k = rng.randrange(60)
        doc = ["x"] + phrase + ["y"] + items[k][1][rng.randint(0, 12):] + ["z"]
        want = []
        for i, w in items:
            covered = sum(t[2] for t in slow_tiles(doc, w, p.seed))
            if 100 * covered >= p.percent * len(w):
                want.append((i, len(w), covered))
        assert [x[:3] for x in index.leaks(doc)] == want


def test_whole_table(spark):
    """Each planted item is found, and blocks do not change the result."""
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = sorted(tuple(r)[:5] for r in L.leaks(docs, items).collect())
    assert found == sorted(tuple(r)[:5] for r in L.leaks(docs, items, L.Tiling(block_words=300)).collect())
    texts = {r.doc_id: " ".join(L.tokens(r.text)) for r in docs.collect()}
    whole = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if " ".join(L.tokens(r.text)) in t}
    assert whole and whole <= {r[:2] for r in found}


def test_reordered_sentences_and_edges(spark):
    item = "one two three four five six. seven eight nine ten eleven twelve. thirteen fourteen fifteen sixteen seventeen."
    moved = "Thirteen fourteen fifteen sixteen seventeen! Noise. ONE two three four five six; more noise, seven eight nine ten eleven twelve"
    docs = documents(spark).unionByName(documents(spark, [(50, moved, "en", "s"), (50, moved, "en", "s"), (51, "one two three four", "en", "s")]))
    bench = spark.createDataFrame([(1, item, "?"), (2, None, "?"), (3, "", "?"), (4, "too short", "?"), (1, item, "?")], "item_id long, text string, covered string")
    assert [(r.doc_id, r.item_id, r.n_words, r.covered, r.n_tiles) for r in L.leaks(docs, bench).collect()] == [(50, 1, 17, 17, 3)] * 4
    kept = L.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert L.leaks(docs, none).collect() == [] and L.leaks(documents(spark, []), bench).collect() == []


def test_windows_at():
    doc = np.arange(1, 30, dtype=np.uint64)
    at = np.array([0, 7, 24])
    assert (L.windows_at(doc, at, 5) == L.windows(doc, 5)[at]).all()


def test_repeated_words():
    """Words that repeat in item and text: equal to the pair-wise search, and no product of places."""
    import random
    import time

    rng = random.Random(5)
    for _ in range(300):
        doc = np.array([rng.randint(1, 2) for _ in range(rng.randint(5, 60))], dtype=np.uint64)
        item = np.array([rng.randint(1, 2) for _ in range(rng.randint(5, 30))], dtype=np.uint64)
        runs = []
        for i in range(len(item)):
            for d in range(len(doc)):
                if i and d and item[i - 1] == doc[d - 1]:
                    continue
                m = 0
                while i + m < len(item) and d + m < len(doc) and item[i + m] == doc[d + m]:
                    m += 1
                if m >= 5:
                    runs.append((m, i, d))
        assert sorted(L.all_matches(doc, item, 5)) == sorted(runs)
    for words, n in (("a ", 20_000), ("a b c ", 7_000)):
        t = time.process_time()
        found = L.Index([(1, L.tokens(words * (300 // (len(words) // 2))))], L.Tiling()).leaks(L.tokens(words * n))
        assert found[0][1:3] == (300, 300) and time.process_time() - t < 5
