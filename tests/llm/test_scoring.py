import duckdb
import pytest

from edge import documents
from triad.llm import scoring as C
from triad.llm.queries import ORACLE

SMALL = "/root/testdata/sf0.001"


def both(spark, folder):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    rel = con.sql(ORACLE["op1_cross_entropy_difference"])
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    got = [r.asDict() for r in C.op1_cross_entropy_difference(spark, folder).collect()]
    order = lambda r: tuple((x is None, x) for x in (r["doc_id"], r["n_words"], r["ce_target"]))
    return sorted(got, key=order), sorted(want, key=order)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert set(g) == set(w)
        for k in g:
            assert g[k] == (pytest.approx(w[k], abs=2e-6) if isinstance(w[k], float) else w[k]), (k, g, w)


def test_equals_sql(spark):
    same(*both(spark, SMALL))


def test_edges(spark, tmp_path):
    docs = documents(spark, clash=False)
    for name, labels in (("a", [(1, 1, 0, "?"), (1, 0, 0, "?"), (5, 1, None, "?"), (None, 1, 0, "?"), (7, None, 0, "?")]), ("b", [])):
        folder = tmp_path / name
        docs.coalesce(1).write.parquet(str(folder / "d"))
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, target string").coalesce(1).write.parquet(str(folder / "l"))
        for t in "dl":
            next((folder / t).glob("part-*")).rename(folder / {"d": "documents.parquet", "l": "labels.parquet"}[t])
        got, want = both(spark, str(folder))
        same(got, want)
        if name == "b":  # no target: both models are uniform
            assert all(abs(r["score"]) < 1e-9 for r in got if r["n_words"])
        assert all(r["ce_target"] is None for r in got if not r["n_words"])
    rows = C.flagged(documents(spark), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert C.score(rows, C.train(rows)).count() == docs.count()
    none = C.flagged(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int"))
    assert C.score(none, C.train(none)).collect() == []


def test_target_like_text_scores_lower(spark):
    good = [(i, "the treaty was signed by all parties in the old town hall", "en", "s") for i in range(40)]
    bad = [(100 + i, "buy cheap pills now and win a free prize in our shop", "en", "s") for i in range(40)]
    new = [(200, "the treaty was signed in the town hall", "en", "s"), (201, "win a free prize now", "en", "s")]
    rows = C.flagged(documents(spark, good + bad + new), spark.createDataFrame([(r[0], 1) for r in good], "doc_id long, quality int"))
    s = {r.doc_id: r.score for r in C.score(rows, C.train(rows)).collect()}
    assert s[200] < 0 < s[201]


def test_rare_words_and_bigrams_count(spark):
    """Many chunks and parts, where most words are rare."""
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    rel = con.sql(ORACLE["op1_cross_entropy_difference"])
    want = sorted(rel.fetchall())
    rows = C.flagged(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    got = sorted(tuple(r) for r in C.score(rows, C.train(rows, C.Bigram(chunk=20_000, part=5_000))).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], abs=2e-6)


def test_a_word_seen_once_tells_nothing_and_twice_does(spark):
    """In 250,000 words a word of two occurrences is under 1e-5 of them."""
    common = " ".join(["one two three four five six seven eight nine ten"] * 250)
    rows = [(i, common, "en", "s") for i in range(100)]
    rows += [(1000, "rare bird", "en", "s"), (1001, "rare bird", "en", "s"), (1002, "lone thing", "en", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in [*range(50), 1000]], "doc_id long, quality int")
    flagged = C.flagged(docs, labels)
    s = {r.doc_id: r for r in C.score(flagged, C.train(flagged)).collect()}
    assert s[1001].score < s[1002].score - 0.1
