import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from edge import ROWS, documents  # noqa: E402
from triad.llm import leaks, near, pii, quality  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    """Every stage against its operator on its own input, over the whole table."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    fs = [f for _, f in corpus_pipeline.STAGES]
    a = fs[0](spark, docs, SMALL).cache()
    assert ids(a) == ids(quality.judged(docs).where("kept"))
    b = fs[1](spark, a, SMALL).cache()
    assert ids(b) == ids(near.near_duplicates(a).where("kept")) and b.count() < a.count()
    c = fs[2](spark, b, SMALL).cache()
    leaked = {r.doc_id for r in leaks.leaks(b, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert ids(c) == [i for i in ids(b) if i not in leaked] and leaked
    d = fs[3](spark, c, SMALL).cache()
    assert ids(d) == ids(c)
    assert not any(pii.base_spans(r.text) for r in d.collect() if r.text)
    e = fs[4](spark, d, SMALL).collect()
    assert {r.doc_id for r in e} == set(ids(d)) and all(r.round_trip for r in e)
    for x in (a, b, c, d):
        assert x.columns == docs.columns


def test_run_and_edges(spark, tmp_path):
    documents(spark, [*ROWS, *[(100 + i, f"A sound text of more than ten words, number {i}, says this and that.", "en", "s") for i in range(3)]]).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} >= {100} and all(r.round_trip for r in out)
    documents(spark, []).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none/benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []


def test_only_rejected_rows_go(spark):
    """Null and repeated ids share no decision."""
    docs = documents(spark)
    kept = [(r.doc_id, r.text) for r in quality.keep_good(docs).collect()]
    assert kept.count((None, ROWS[7][1])) == 1 and (None, None) not in kept
    mixed = documents(spark, [*ROWS, (1, "too short", "en", "s")])
    assert [r.text for r in quality.keep_good(mixed).collect() if r.doc_id == 1] == [r[1] for r in ROWS if r[0] == 1]

    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, item, "en", "s"), (None, "a clean text", "en", "s"), (5, f"so {item} it is", "en", "s"), (5, "another text", "en", "s"), (6, item, "en", "s")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.text for r in leaks.drop_leaks(documents(spark, rows), bench).collect()) == ["a clean text", "another text"]


def test_one_row_of_each_group_stays(spark):
    def text(a):
        return " ".join(f"{a}{i}" for i in range(60))

    rows = [(3, text("u"), "en", "s"), (5, text("u") + " end", "en", "s"), (5, text("x"), "en", "s"), (7, text("x"), "en", "s"),
            (8, text("y"), "en", "s"), (8, text("y"), "en", "t"), (8, text("y") + " end", "en", "s"), (9, text("y"), "en", "s"),
            (8, text("z"), "en", "s"), (None, text("x"), "en", "s"), (None, text("v"), "en", "s"), (None, text("v"), "en", "s"), (2, None, "en", "s"), (2, None, "en", "s")]
    docs = documents(spark, rows)
    out = near.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, (r.text or "-")[:1]) for r in out.collect()))
    assert got == [(0, "v"), (0, "v"), (2, "-"), (2, "-"), (3, "u"), (5, "x"), (8, "y"), (8, "z")]
