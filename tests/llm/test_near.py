import re
from itertools import combinations

import numpy as np
import pytest

from edge import ROWS, documents
from triad.llm import near as N

SMALL = "/root/testdata/sf0.001/documents.parquet"


def shingles(text, n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def brute(rows, p):
    """(doc_id, set size, component, kept) by comparing all pairs."""
    sets = [shingles(t, p.shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= p.percent * len(a | b):
            root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((d, len(sets[i]), c, d == c))
    return out


def got(docs, p):
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(docs, p).collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("p", [N.Near(shingle=3, percent=85), N.Near()])
def test_equals_brute_force(spark, p):
    docs = spark.read.parquet(SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert key(got(docs, p)) == key(brute(rows, p))


def test_edges(spark):
    docs = documents(spark)
    for p in (N.Near(shingle=3, percent=85), N.Near()):
        assert key(got(docs, p)) == key(brute([r[:2] for r in ROWS], p))
    assert N.keep_one(docs).columns == docs.columns
    assert got(documents(spark, []), N.Near()) == []


def test_chains_and_changed_copies(spark):
    """A chain in which no center reaches all, and copies changed more and less."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):  # drifts: neighbours are near, far ones are not
        base[i % 120] = f"v{i}"
        rows.append((500 - i, " ".join(base), "en", "s"))
    rng = np.random.default_rng(2)
    rows += [(2000 + i, " ".join(f"x{j}" if rng.random() > 0.004 * i else f"y{i}.{j}" for j in range(150)), "en", "s") for i in range(60)]
    rows += [(1000 + i, "same text " + " ".join(f"z{j}" for j in range(40)), "en", "s") for i in range(50)]
    p = N.Near(shingle=3, percent=85)
    assert key(got(documents(spark, rows), p)) == key(brute([r[:2] for r in rows], p))


def test_odd_sketch_estimates(spark):
    p = N.Near()
    rng = np.random.default_rng(5)
    for j in (0.8, 0.85, 0.9, 0.95):
        n = 2000
        both = rng.integers(0, 2**63, size=int(n * j), dtype=np.uint64)
        only = rng.integers(0, 2**63, size=n - len(both), dtype=np.uint64)
        half = len(only) // 2
        odd = N.odd_sketches(N.minhash([np.r_[both, only[:half]], np.r_[both, only[half:]]], p), p)
        z = sum(int(x).bit_count() for x in odd[0] ^ odd[1])
        bits = 64 * p.words
        assert abs(1 + bits / (4 * p.samples) * np.log(1 - 2 * z / bits) - j) < 0.1
