import numpy as np
import pytest

from edge import ROWS, documents
from triad.llm import language as G

MID = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = G.op6_bitsliced_langid(spark, MID)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    rows = out.join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out and lang is not null and length(text) > 40").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def naive_grams(text, order):
    words, word = [], ""
    for c in (text or "").lower():
        if c.isalpha():
            word += c
        else:
            words.append(word)
            word = ""
    words.append(word)
    n = 0
    for w in words:
        w = f" {w} "
        n += max(0, len(w) - order + 1) if len(w) > 2 else 0
    return n


def test_ngrams_by_text():
    texts = [r[1] for r in ROWS] + ["a bc def-ghij", "Él año", "1 2 3", "ab"]
    gram, owner = G.ngrams(texts, 4)
    assert len(gram) == len(owner)
    for i, t in enumerate(texts):
        assert (owner == i).sum() == naive_grams(t, 4)
    one, _ = G.ngrams(["def ghij"], 4)
    assert set(one) <= set(G.ngrams(["abc def ghij klm"], 4)[0])


def test_masks_contain_every_owner():
    """A Bloom filter has no false negatives, and its rate corrects the false positives."""
    gram = {lang: G.ngrams([" ".join(f"{lang}{i:04d}xyz".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(800))], 4)[0] for lang in ("pp", "qq", "rr")}
    model = G.Sliced(gram, G.Filters(slots=1 << 10))
    for i, lang in enumerate(model.langs):
        at = list(model.spots(gram[lang]))
        mask = model.tables[0][at[0]] & model.tables[0][at[1]] & model.tables[0][at[2]]
        assert ((mask >> i) & 1 == 1).all()
    share, _ = model.shares(["zzzz wwww uuuu tttt vvvv " * 200])
    assert (share < 0.35).all()


def test_more_than_64_languages():
    grams = {f"l{i:03d}": G.ngrams([chr(0x4E00 + 3 * i) * 6], 4)[0] for i in range(70)}
    model = G.Sliced(grams, G.Filters())
    share, _ = model.shares([chr(0x4E00 + 3 * i) * 6 for i in range(70)])
    assert (share.argmax(axis=1) == range(70)).all() and len(model.tables) == 2


def test_edges(spark):
    docs = documents(spark)
    model = G.learn(docs)
    out = G.predict(docs, model).collect()
    assert len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.lang_pred == "und" and r.score == 0 for i in (2, 3, 4) for r in by[i])
    assert by[6][0].lang_pred in ("de", "en", "fr")
    nothing = G.learn(documents(spark, []))
    assert {r.lang_pred for r in G.predict(docs, nothing).collect()} == {"und"}


def test_spark_sets_the_bits_of_every_owned_ngram(spark):
    """The learned table equals one built from a naive count; nothing is left out as a corpus grows."""
    rows = [(i, f"alpha beta w{chr(97 + i % 26)}{chr(97 + i // 26)}x", "en" if i % 2 else "de", "s") for i in range(400)]
    docs = documents(spark, rows)
    f = G.Filters()
    count = {}
    for _, text, lang, _ in rows:
        for g in G.ngrams([text], f.order)[0].tolist():
            count[lang, g] = count.get((lang, g), 0) + 1
    total = {x: sum(v for (a, _), v in count.items() if a == x) for x in ("de", "en")}
    best = {}
    for (lang, g), v in count.items():
        best[g] = max(best.get(g, 0), v / total[lang])
    owned = {x: np.array([g for (a, g), v in count.items() if a == x and v >= 2 and v / total[x] >= f.stray * best[g]], dtype=np.uint64) for x in ("de", "en")}
    model, want = G.learn(docs, f), G.Sliced(owned, f.sized(max(map(len, owned.values()))))
    assert model.langs == want.langs and model.f == want.f and (model.rate == want.rate).all()
    assert all((a == b).all() for a, b in zip(model.tables, want.tables, strict=True))
    assert f.sized(10**12).slots == f.most_slots and f.sized(10**6).slots >= 12 * 10**6


@pytest.mark.parametrize("doc_id, held", [("0", None), ("17", None)])
def test_fold_is_crc32_of_text(spark, doc_id, held):
    import zlib
    got = spark.createDataFrame([(int(doc_id),)], "doc_id long").select(G.fold()).first()[0]
    assert got == zlib.crc32(doc_id.encode()) % 4
