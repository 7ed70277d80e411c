import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from edge import ROWS, documents
from triad.llm import pii as P


def slow_spans(text):
    """The base patterns as they are stated."""
    out = [(*m.span(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((*m.span(), 2))
    out += [(*m.span(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="0123456789.@+-() aZ_é%", max_size=60))
def test_base_equals_patterns(text):
    assert P.base_spans(text) == slow_spans(text)


def test_base_on_tables(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert P.base_spans(r.text) == slow_spans(r.text)


def corpus():
    """Calls with numbers the fixed patterns know, then without the plus sign."""
    rows = [(i, f"Please dial +1 555 010 {1000 + i} today, my friend", "en", "s") for i in range(30)]
    rows += [(100 + i, f"Please dial 555-010-{2000 + i} today, my friend", "en", "s") for i in range(5)]
    rows += [(200 + i, f"Order {i} of {555000000 + i} pieces came", "en", "s") for i in range(20)]
    return rows


def test_patterns_find_unseen_identifiers(spark):
    out = {r.doc_id: r for r in P.personal_data(documents(spark, corpus())).collect()}
    for i in range(30):
        assert [tuple(s) for s in out[i].spans] == [tuple(s) for s in out[i].base] and len(out[i].base) == 1
    for i in range(5):
        assert out[100 + i].base == [] and [tuple(s) for s in out[100 + i].spans] == [(12, 24, 3)]
    assert all(out[200 + i].spans == [] for i in range(20))


def test_known_instance_elsewhere(spark):
    """A card known from one text is found where two cards in a row hid it."""
    rows = [(1, "card 4465758382889437 given", "en", "s"), (2, "x 4465758382889437 4465758382889437 y", "en", "s")]
    out = {r.doc_id: [tuple(s) for s in r.spans] for r in P.personal_data(documents(spark, rows)).collect()}
    assert out == {1: [(5, 21, 2)], 2: [(2, 18, 2), (19, 35, 2)]}


def test_query_columns(spark, tmp_path):
    documents(spark, [*ROWS, (9, "a.b@mail.org and 10.0.0.1", "en", "s")]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = P.op5_bootstrapped_pii(spark, str(tmp_path)).collect()
    assert len(rows) == len(ROWS) + 1
    r = next(r for r in rows if r.doc_id == 9)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)
    assert r.spans == "email:0:12,ip:17:25" and r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert all(x.spans == "" and x.base_sha256 == hashlib.sha256(b"").hexdigest() for x in rows if x.doc_id in (2, 3, 4))


def test_redaction(spark):
    docs = documents(spark, [*ROWS, *corpus(), (9, "é a.b@mail.org!", "en", "s")])
    out = P.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r.doc_id: r for r in out.collect() if r.doc_id in (9, 101) or r.text in (None, "", ROWS[5][1]) or r.doc_id == 0}
    assert by[9].text == "é [EMAIL]!" and by[9].n_chars == len(by[9].text)
    assert by[0].text == "Please dial [PHONE] today, my friend" and by[101].text == "Please dial [PHONE] today, my friend"
    assert by[2].text is None and by[3].text == "" and by[5].text == ROWS[5][1]
    assert P.redact(documents(spark, [])).collect() == [] and P.personal_data(documents(spark, [])).collect() == []


def test_mask_overlaps():
    assert P.mask("abcdefgh", [(0, 2, 0), (1, 4, 1), (4, 5, 2), (7, 8, 3)]) == "[EMAIL][CARD]fg[PHONE]"


def test_identifiers_with_blanks(spark):
    """Numbers written in groups, as most seeds are, can be discovered."""
    cards = [c for c in (f"4465 7583 8288 {n:04d}" for n in range(400)) if P.luhn(P.digits(c))][:30]
    bad = "4465 7583 8288 9430"
    assert not P.luhn(P.digits(bad))
    rows = [(i, f"Please dial +1 555 010 {1000 + i} today, my friend", "en", "s") for i in range(40)]
    rows += [(50 + i, f"my card {c} expires soon", "en", "s") for i, c in enumerate(cards)]
    rows += [(100, "Please dial 555 010 2000 today", "en", "s"), (101, "Please dial (017) 555 7713 today", "en", "s"),
             (102, f"my card {bad} expires soon", "en", "s"), (103, "It has 555 010 2999 parts", "en", "s")]
    out = {r.doc_id: [tuple(s) for s in r.spans] for r in P.personal_data(documents(spark, rows)).collect()}
    assert out[100] == [(12, 24, 3)] and out[101] == [(12, 26, 3)] and out[102] == [(8, 27, 2)] and out[103] == []


def test_long_address_parts():
    assert P.base_spans("1.2.3." + "9" * 5000) == [] and P.base_spans("1.2.3." + "0" * 5000 + "255")[0][2] == 1


def test_one_start_is_ordered_by_kind(spark, tmp_path):
    """Written out by hand: start, then email, ip, card, phone."""
    rows = [(1, "4111111111111111@mail.example.com", "en", "s"), (2, "to 1.2.3.4@x.com", "en", "s")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.spans, r.base_sha256) for r in P.op5_bootstrapped_pii(spark, str(tmp_path)).collect()}
    want = {1: "email:0:33,card:0:16", 2: "email:3:16,ip:3:10"}
    assert got == {i: (s, hashlib.sha256(s.encode()).hexdigest()) for i, s in want.items()}


def test_context_words_are_whole():
    long = "w" * 1000
    assert P.words_before(f"{long} {long} 5", 2002, 120) == [long, long] and P.word_after(f"5 {long} x", 1, 120) == [long]
    assert P.words_before("a  b", 4, 1) == ["a", "b"] and P.words_before("", 0, 5) == [] and P.word_after("x", 1, 5) == []
