import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from edge import ROWS, documents
from triad.llm import segment as S

P = S.Sampling()


@pytest.fixture(scope="module")
def pieces():
    return S.Pieces(P)


def all_segmentations(text, pieces):
    """Every segmentation of a text with its probability, by enumeration."""
    norm = (" " + text).replace(" ", S.BLANK)
    vocabulary = {}
    for i, t in enumerate(pieces.texts):
        if t and i not in set(pieces.byte_ids.tolist()):
            vocabulary.setdefault(t.decode().replace(" ", S.BLANK), i)
    out = []

    def go(at, ids, w):
        if at == len(norm):
            out.append((tuple(ids), w))
            return
        if norm[at] not in vocabulary:
            go(at + 1, ids + [int(pieces.byte_ids[b]) for b in norm[at].encode()], w + pieces.weight[-1])
        for end in range(at + 1, min(len(norm), at + pieces.longest) + 1):
            # no piece crosses the start of a run of blanks
            if norm[at:end] in vocabulary:
                i = vocabulary[norm[at:end]]
                go(end, ids + [i], w + pieces.weight[i])

    go(0, [], 0.0)
    z = math.log(sum(math.exp(w) for _, w in out))
    return {ids: w - z for ids, w in out}


@pytest.mark.parametrize("text", ["ab", "the cat", "  a\n b", "é\U0001F600x", "aaa aaa"])
def test_all_segmentations_without_replacement(pieces, text):
    """With k as large as the number of segmentations each comes once, with its probability."""
    want = all_segmentations(text, pieces)
    got = S.sample([text], np.array([7], dtype=np.uint64), pieces, S.Sampling(k=len(want) + 3))[0]
    assert sorted(tuple(ids.tolist()) for ids, *_ in got) == sorted(want)
    for ids, lp, _, inc in got:
        assert lp == pytest.approx(want[tuple(ids.tolist())], abs=1e-9) and inc == 0.0
    assert [g for *_, g, _ in got] == sorted((g for *_, g, _ in got), reverse=True)


def test_distribution(pieces):
    """First samples follow the model; k=2 pairs follow sampling without replacement."""
    want = all_segmentations("the at", pieces)
    n = 20_000
    got = S.sample(["the at"] * n, S.mix(np.arange(n, dtype=np.uint64)), pieces, P)
    first = Counter(tuple(r[0][0].tolist()) for r in got)
    either = Counter(tuple(s[0].tolist()) for r in got for s in r)
    for ids, lp in want.items():
        p = math.exp(lp)
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
        both = p + sum(math.exp(q) * p / (1 - math.exp(q)) for other, q in want.items() if other != ids)
        assert abs(either[ids] / n - both) < 5 * math.sqrt(both / n) + 1e-3
    # inclusion scores are unbiased: the sum of p / inclusion over the sample is 1 on average
    total = [sum(math.exp(lp - inc) for _, lp, _, inc in r) for r in got]
    assert abs(np.mean(total) - 1) < 0.02


def test_round_trip_and_partitions(spark, pieces):
    docs = documents(spark, [*ROWS, (60, "two  blanks, a tab\tand no end ", "en", "s")])
    rows = sorted((r.doc_id or -1, str(r)) for r in S.encoded(docs).collect())
    assert rows == sorted((r.doc_id or -1, str(r)) for r in S.encoded(docs.repartition(7)).collect())
    found = S.encode(docs).collect()
    assert len(found) == len(ROWS) + 1
    for r in found:
        assert r.samples is None or all(s.round_trip for s in r.samples)
    by = {r.doc_id: r.samples for r in found}
    assert by[2] is None and [(s.ids, s.log_prob, s.log_inclusion) for s in by[3]] == [([], 0.0, 0.0)]
    assert S.encode(documents(spark, [])).collect() == []


def test_decode(spark):
    docs = documents(spark, [(1, "Hello  world\n foo é\U0001F600", "en", "s"), (2, None, "en", "s")])
    texts = [r.text for r in S.decode(S.encoded(docs).select("doc_id", "sample", "ids")).collect()]
    assert texts == ["Hello  world\n foo é\U0001F600"] * 2


def test_library_decodes_the_same(pieces):
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=P.model)
    text = "Any text, with Größe and 数字 — in it.\nTwo lines"
    for ids, *_ in S.sample([text], np.array([1], dtype=np.uint64), pieces, S.Sampling(k=5))[0]:
        assert sp.decode(ids.tolist()) == text


def test_a_chunk_is_looked_up_once(monkeypatch):
    """Numbering the chunks hashes each occurrence once, and each distinct chunk once more."""
    seen = []

    class Word(str):
        __slots__ = ()
        __eq__ = str.__eq__

        def __hash__(self):
            seen.append(self)
            return str.__hash__(self)

    class Cut:
        @staticmethod
        def findall(text):
            return [Word(x) for x in S.re.findall(r" *[^ \n]+|\n| +", text)]

    texts, p = ["one two one two " * 50, "two one", ""], S.Sampling()
    pieces = S.Pieces(p)
    keys = np.arange(3, dtype=np.uint64)
    plain = S.sample(texts, keys, pieces, p)
    monkeypatch.setattr(S, "CHUNK", Cut)
    counted = S.sample(texts, keys, pieces, p)
    for a, b in zip(plain, counted, strict=True):
        assert [(x[0].tolist(), *x[1:]) for x in a] == [(x[0].tolist(), *x[1:]) for x in b]
    assert 203 <= len(seen) <= 203 + 6


def test_memory_of_a_large_batch(pieces):
    """The arrays are bounded by a slice, not by the batch; the samples do not depend on the slices."""
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 12, 40_000)]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 400)) for _ in range(1_000)]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": texts, "row_key": list(range(n))})
    assert batch.column("text").nbytes > 2.5e6
    tracemalloc.start()
    sizes = [b.num_rows for b in S.sampled(iter([batch]), pieces, P)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == n
    assert peak < 120e6
    last = list(S.sampled(iter([batch.slice(n - sizes[-1])]), pieces, P))
    alone = list(S.sampled(iter([batch.slice(n - 1)]), pieces, P))
    assert last[0].column("samples")[-1] == alone[0].column("samples")[0]
