import math
from collections import Counter

import numpy as np
import pytest

from edge import ROWS, documents
from triad.llm import quality as Q

SMALL = "/root/testdata/sf0.001/documents.parquet"


def slow_counts(text):
    """The base counts in the plainest way."""
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_counts(spark):
    texts = [r[1] for r in ROWS] + ["a b c d e f a b c d e g a b c d e", "x\nx\n \nx y\nx y", "a " * 30, "%% ## $$ é|ß <b>"]
    texts += [r.text for r in spark.read.parquet(SMALL).select("text").collect()]
    for t in texts:
        assert Q.count_text(t.encode() if t else t)[:5] == slow_counts(t)


def brute(rows, p):
    """The estimate and verdicts by loops over plain arrays."""
    rows = [dict(r, usable=not (r["n_words"] < p.min_words or 100 * r["n_repeat_words"] > p.max_repeat_percent * r["n_words"])) for r in rows]
    root = lambda a, b, k: math.asin(math.sqrt(min(1.0, a / (b + k))))
    for r in rows:
        r["x"] = np.array([math.log((r["word_chars"] + 275) / (r["n_words"] + 50)), root(r["n_symbols"], r["word_chars"], 50), root(r["n_dup_lines"], r["n_lines"], 5),
                           root(r["n_repeat_words"], r["n_words"], 50), root(r["n_other"], r["word_chars"], 100)])
    size = Counter((r["lang"], r["source"]) for r in rows if r["usable"])
    pool = Counter()
    for (lang, _), n in size.items():
        pool[lang] += n if n < p.least else 0
    gid = lambda r: (r["lang"], r["source"]) if size[r["lang"], r["source"]] >= p.least else (r["lang"],) if pool[r["lang"]] >= p.least else ()
    groups = {}
    for r in rows:
        if r["usable"]:
            groups.setdefault(gid(r), []).append(r["x"])
    est = {}
    floor = np.diag(np.square(Q.FLOORS))

    def at(z, s):
        b = sorted(math.floor(v / 0.01) for v in z)
        return (b[math.ceil(s * len(b)) - 1] + 0.5) * 0.01

    for g, z in groups.items():
        z = np.array(z)
        found = []
        for start in (0, 1):
            m, cov = z.mean(axis=0), np.cov(z.T, bias=True).reshape(5, 5)
            if start:
                m = np.array([at(c, 0.5) for c in z.T])
                cov = np.diag([((at(c, 0.75) - at(c, 0.25)) / 1.349) ** 2 for c in z.T])
            for _ in range(p.steps):
                q = np.linalg.inv(cov + floor)
                b = np.floor(np.log2(np.maximum(np.einsum("ni,ij,nj->n", z - m, q, z - m), Q.LEAST_D2)) * Q.BIN)
                inside = z[b <= np.sort(b)[math.ceil(p.share * len(b)) - 1]]
                m, cov = inside.mean(axis=0), np.cov(inside.T, bias=True).reshape(5, 5)
            found.append((round(np.linalg.slogdet(cov + floor)[1], 6), start, m, np.linalg.inv(cov + floor)))
        _, _, m, q = min(found, key=lambda f: f[:2])
        b = np.sort(np.floor(np.log2(np.maximum(np.einsum("ni,ij,nj->n", z - m, q, z - m), Q.LEAST_D2)) * Q.BIN))
        est[g] = m, q, max(1.0, 2 ** ((b[math.ceil(p.share * len(b)) - 1] + 1) / Q.BIN) / Q.chi_square(p.share, 5))
    out = []
    for r in rows:
        m, q, scale = est.get(gid(r), (r["x"], np.zeros((5, 5)), 1.0))
        out.append((r["doc_id"], r["usable"] and float((r["x"] - m) @ q @ (r["x"] - m)) / scale <= Q.chi_square(1 - p.tail, 5)))
    return out


@pytest.mark.parametrize("least", [5, 60])
def test_verdicts_equal_brute_force(spark, least):
    p = Q.Mcd(least=least, tail=1e-3, steps=3)
    docs = spark.read.parquet(SMALL)
    counts = [r.asDict() for r in Q.text_counts(docs).collect()]
    got = [(r.doc_id, r.kept) for r in Q.judged(docs, p).collect()]
    assert sorted(got) == sorted(brute(counts, p))
    assert any(k for _, k in got) and not all(k for _, k in got)


def test_edges_and_stage(spark):
    docs = documents(spark)
    out = Q.judged(docs).collect()
    assert len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.base_failed and not r.kept for i in (2, 3, 4, 6) for r in by[i])
    assert [r.kept for r in by[1]] == [True] * 3
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id == 1) == [1, 1, 1]
    assert {2, 3, 4, 6}.isdisjoint({r.doc_id for r in kept.collect()})


def test_empty_table(spark):
    docs = documents(spark, [])
    assert Q.judged(docs).collect() == [] and Q.keep_good(docs).collect() == []


def test_symbols_are_rejected_and_plain_text_kept(spark):
    rows = [(i, " ".join(f"word{j * i % 89} of" for j in range(40)), "en", "a") for i in range(1, 151)]
    rows += [(1000 + i, " ".join(f"w{j * i % 89}%%% ***" for j in range(40)), "en", "a") for i in range(10)]
    out = {r.doc_id: r for r in Q.judged(documents(spark, rows)).collect()}
    assert not any(out[1000 + i].kept for i in range(10))
    assert all(r.kept for i, r in out.items() if i < 1000 and not r.base_failed)
