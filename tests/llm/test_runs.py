"""Periodic runs against a brute-force search over all periods."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL
from edge import LONG, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from triad.llm import runs as R


def brute(words: list, least: int = 24) -> list[tuple[int, int, int]]:
    """Every maximal stretch of every period, smallest periods only."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                b, e = i, j + q
                if not any(b2 <= b and e <= e2 and q % q2 == 0 for b2, e2, q2 in out if q2 < q):
                    out.append((b, e, q))
            i = max(j, i + 1)
    return sorted(((b, e - b, q) for b, e, q in out), key=lambda r: (r[0], r[2]))


def found(texts: list[list]) -> list:
    return [r for _, r in R.batch_runs([" ".join(map(str, t)).encode() for t in texts])]


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_of_texts_with_loops(seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(60):
        t = []
        while len(t) < rng.integers(0, 900):
            q, letters = int(rng.integers(1, 120)), int(rng.integers(1, 5))
            root = rng.integers(0, letters, q).tolist()
            if rng.random() < .3:                                       # a loop made of loops
                root = (root[:7] * 6)[:q] + [9]
            t += root * int(rng.integers(1, 6)) + root[:int(rng.integers(0, q + 1))]
            t += rng.integers(0, 50, int(rng.integers(0, 9))).tolist()
        texts.append(t)
    assert found(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=160), max_size=4), st.integers(1, 40), st.integers(1, 7))
def test_any_words(texts, q, k):
    texts = texts + [t[:q] * k for t in texts]
    assert found(texts) == [brute(t) for t in texts]


def test_fibonacci_and_one_word():
    a, b = [0], [0, 1]
    while len(b) < 1200:
        a, b = b, b + a
    texts = [b, [5] * 1500, list(range(400)) * 3, list(range(400)) * 3 + [0], []]
    assert found(texts) == [brute(t) for t in texts]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    drop = {i for b, m, q in runs for i in range(b + q, b + m)}
    listed = "".join(f"{b},{m},{q}\n" for b, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    few = [d for d in docs if len((d[1] or "").split()) < 3000]
    got = [tuple(r) for r in R.op12_periodic_runs(spark, SF_SMALL).select(NAMES).collect()]
    assert len(got) == len(docs)
    got = {r[0]: r for r in got}
    want = [expected(*d) for d in few]
    assert sum(w[1] for w in want) > 5
    assert [got[w[0]] for w in want] == want


def test_edges(spark, monkeypatch, tmp_path):
    docs = documents(spark)
    out = [tuple(r) for r in R.periodic_runs(docs).select("doc_id", "n_words", "collapsed").collect()]
    assert len(out) == docs.count()
    assert (3, 0, "") in out and (2, 0, "") in out and (None, 0, "") in out
    long = [r for r in out if r[0] == 5][0]
    assert long[1] == len(LONG.split())
    assert R.periodic_runs(docs.limit(0)).collect() == []
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert R.op12_periodic_runs(spark, str(tmp_path)).count() == docs.count()
