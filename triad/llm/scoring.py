"""Cross-entropy difference of matched n-gram models.

The target model is counted over the documents labelled good, the background
model over all other documents.  Both are bigram models over one vocabulary with
one set of bigrams and the same smoothing, and the larger corpus's counts are
scaled to the smaller's total, so that their losses differ only by what the
corpora say.  Every word and every bigram counts, however rare; the vocabulary is
all words of both corpora and one unknown word, which has no count.

p(w | h) = (c(h, w) + mu p(w)) / (c(h) + mu) with c(h) the bigrams that begin with
h, and p(w) = (c(w) + beta) / (N + beta V); a document's first word has p(w).  A
document's own counts are taken out of its own model before it is scored (leave
one out), so no document is likely because it was counted.  The score is the mean
over its words of the loss under the target model less that under the background
model: low is like the target.

No model is gathered anywhere.  Documents of one corpus are packed into chunks of
about ``chunk`` words, which are written once.  A chunk asks for the totals of its
distinct words and bigrams: sorted 64-bit hashes and the chunk's own counts, one
block for each range of hashes.  A range is one group, which adds up what the
chunks sent and answers every block with the totals of its keys; the number of
ranges follows the corpus, and a frequent key is one entry of a block like any
other.  A chunk's answers meet it again by its number and score its documents.

Defined results: words are runs of anything but ASCII white space, A-Z in lower
case.  Null, empty and white texts have 0 words and null losses.  A doc_id with
any label 1 is a target; repeated rows count and are scored each.  Without any
target or background both scaled models are uniform and scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, cut, raw, slices
from triad.llm.words import Hashes, windows

TARGET_BROADCAST_ROWS = 1_000_000
WORDS, PAIRS = 0, 1
U = np.uint64


@dataclass(frozen=True)
class Bigram:
    beta: float = 0.5
    mu: float = 20.0
    chunk: int = 1_000_000       # words after which a chunk is closed
    part: int = 500_000          # words of the corpus for each range of hashes


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, target of every row.  The ids are broadcast only when few."""
    good = columns(labels, doc_id="long", quality="int").where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").alias("_good")).distinct()
    good = F.broadcast(good) if good.count() <= TARGET_BROADCAST_ROWS else good
    src = columns(docs, doc_id="long", text="string")
    return src.join(good, src["doc_id"] == good["_good"], "left").select(
        "doc_id", "text", F.col("_good").isNotNull().alias("target"))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes."""
    plain = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(plain, codec="zstd", asbytes=True) if plain else b"")


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.empty(0, dtype=U)
    plain = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, dtype=np.uint8).reshape(8, n).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=U)


CHUNK = "chunk long, target boolean, doc_ids array<long>, n array<long>, words binary, places binary"


def chunks(rows: DataFrame, p: Bigram) -> DataFrame:
    """The rows by chunks: their doc_ids and numbers of words, the sorted hashes of
    the chunk's words, and of each running word its place among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, number = Hashes(), TaskContext.get().partitionId() << 32
        held = {True: ([], []), False: ([], [])}  # by target: doc_ids, hashes

        def out(target: bool) -> pa.RecordBatch:
            nonlocal number
            ids, hashes = held[target]
            words, places = np.unique(np.concatenate(hashes), return_inverse=True)
            cols = [pa.array([x], t) for x, t in (
                (number, pa.int64()), (target, pa.bool_()), (ids, pa.list_(pa.int64())), ([len(h) for h in hashes], pa.list_(pa.int64())),
                (pack_sorted(words), pa.binary()), (pack(places), pa.binary()))]
            number += 1
            held[target] = ([], [])
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "target", "doc_ids", "n", "words", "places"])

        size = {True: 0, False: 0}
        for b in slices(batches, "text"):
            for doc_id, text, target in zip(b.column("doc_id").to_pylist(), raw(b, "text"), b.column("target").to_pylist(), strict=True):
                h = seen.of((text or b"").lower().split())
                held[target][0].append(doc_id)
                held[target][1].append(h)
                size[target] += len(h) + 1
                if size[target] >= p.chunk:
                    yield out(target)
                    size[target] = 0
        for target in (True, False):
            if held[target][0]:
                yield out(target)

    return rows.mapInArrow(run, CHUNK)


def inner(n: np.ndarray) -> np.ndarray:
    """Which running words but the chunk's last are followed by a word of the same document."""
    ends = np.cumsum(n)
    out = np.ones(max(0, int(n.sum()) - 1), dtype=bool)
    out[ends[(ends > 0) & (ends <= len(out))] - 1] = False
    return out


def asked(chunked: DataFrame, kind: int, parts: int) -> DataFrame:
    """kind, part, chunk, target, keys, counts, lasts: a chunk's distinct keys of a kind
    in one range, and how often they are there and there as a document's last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, target, n, words, places in zip(
                    *(b.column(c).to_pylist() for c in ("chunk", "target", "n", "words", "places")), strict=True):
                n, words, at = np.array(n, dtype=np.int64), unpack_sorted(words), unpack(places).astype(np.int64)
                if kind == WORDS:
                    keys, counts = words, np.bincount(at, minlength=len(words))
                    lasts = np.bincount(at[np.cumsum(n)[n > 0] - 1], minlength=len(words))
                else:
                    keys, counts = np.unique(windows(words[at], 2)[inner(n)], return_counts=True)
                    lasts = np.zeros(len(keys), dtype=np.int64)
                edge = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
                found = [(k, lo, hi) for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if lo < hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(found), pa.int32()), pa.array([k for k, _, _ in found], pa.int64()),
                     pa.array([chunk] * len(found), pa.int64()), pa.array([target] * len(found), pa.bool_()),
                     pa.array([pack_sorted(keys[lo:hi]) for _, lo, hi in found], pa.binary()),
                     *[pa.array([pack(x[lo:hi]) for _, lo, hi in found], pa.binary()) for x in (counts, lasts)]],
                    names=["kind", "part", "chunk", "target", "keys", "counts", "lasts"])

    return chunked.mapInArrow(run, "kind int, part long, chunk long, target boolean, keys binary, counts binary, lasts binary")


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of each key, which never falls from one sorted key to the next."""
    return ((keys >> U(32)) * U(parts) >> U(32)).astype(np.int64)


TOTALS = ("t", "b", "t_last", "b_last")


def answered(blocks: DataFrame) -> DataFrame:
    """chunk, kind, part, TOTALS over all chunks in the order of the block's keys,
    and ``distinct``: the range's keys, once."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["chunk", "kind", "part", "target", "keys", "counts", "lasts"]).to_pylist()
        sent = [unpack_sorted(r["keys"]) for r in rows]
        keys, at = np.unique(np.concatenate(sent), return_inverse=True)
        side = np.repeat([r["target"] for r in rows], [len(k) for k in sent])
        sums = []
        for c in ("counts", "lasts"):
            w = np.concatenate([unpack(r[c]) for r in rows]).astype(np.float64)
            sums += [np.bincount(at, weights=w * (side == s), minlength=len(keys)).astype(np.int64) for s in (True, False)]
        edge = np.cumsum([0] + [len(k) for k in sent])
        own = [at[lo:hi] for lo, hi in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table(
            [pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([r["kind"] for r in rows], pa.int32()),
             pa.array([r["part"] for r in rows], pa.int64()), *[pa.array([pack(x[i]) for i in own], pa.binary()) for x in sums],
             pa.array([len(keys)] + [0] * (len(rows) - 1), pa.int64())], names=["chunk", "kind", "part", *TOTALS, "distinct"])

    return blocks.groupBy("kind", "part").applyInArrow(
        run, "chunk long, kind int, part long, " + ", ".join(f"{c} binary" for c in TOTALS) + ", distinct long")


@dataclass(frozen=True)
class Model:
    """Chunks of the counted rows and the totals of their keys."""

    rows: DataFrame
    chunked: DataFrame
    answers: DataFrame
    total: tuple[int, int]       # words of the target and of the background
    size: int                    # the vocabulary, with the unknown word
    p: Bigram


def train(rows: DataFrame, p: Bigram = Bigram()) -> Model:
    """The model of flagged ``rows`` (doc_id, text, target)."""
    chunked = cut(chunks(rows, p))
    words = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    t, b = chunked.agg(F.sum(F.when(F.col("target"), words)), F.sum(F.when(~F.col("target"), words))).first()
    total = (t or 0, b or 0)
    parts = max(64, -(-sum(total) // p.part))
    words = cut(answered(asked(chunked, WORDS, parts)))
    size = words.agg(F.sum("distinct")).first()[0] or 0
    return Model(rows, chunked, words.unionByName(answered(asked(chunked, PAIRS, parts))), total, size + 1, p)


def own_counts(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each running key is in its document."""
    _, at, many = np.unique(doc << 32 | key, return_inverse=True, return_counts=True)
    return many[at]


def losses(target: bool, n: np.ndarray, words: np.ndarray, at: np.ndarray, word_totals: np.ndarray, pair_totals: np.ndarray,
           total: tuple[int, int], size: int, p: Bigram) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss of the chunk's documents under both models, each one's own counts taken out."""
    doc, full = np.repeat(np.arange(len(n)), n), n > 0
    ends = np.cumsum(n)
    first = np.zeros(len(at), dtype=bool)
    first[(ends - n)[full]] = True
    last = np.zeros(len(n), dtype=np.int64)
    last[full] = at[ends[full] - 1]
    own = own_counts(doc, at)
    own_context = own - (at == last[doc])
    follows = inner(n)
    _, pair = np.unique(windows(words[at], 2)[follows], return_inverse=True)
    own_pair = own_counts(doc[1:][follows], pair)
    before = np.flatnonzero(follows)  # places of the contexts; the words follow them
    out = []
    for side in (0, 1):
        mine = side == (0 if target else 1)
        scale = min(total) / max(total[side], 1)
        c = word_totals[side][at] - own * mine
        uni = (c * scale + p.beta) / ((total[side] - n[doc] * mine) * scale + p.beta * size)
        loss = -np.log(uni)
        context = (word_totals[side] - word_totals[2 + side])[at] - own_context * mine
        both = pair_totals[side][pair] - own_pair * mine
        loss[before + 1] = -np.log((both * scale + p.mu * uni[before + 1]) / (context[before] * scale + p.mu))
        out.append(np.bincount(doc, weights=loss, minlength=len(n)) / np.maximum(n, 1))
    return out[0], out[1]


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, target, n_words, ce_target, ce_background, score of every flagged row.

    ``rows`` are those that the model was made of: each is scored without itself."""
    if rows is not model.rows:
        raise ValueError("only the rows that the model was made of can be scored")
    total, size, p = model.total, model.size, model.p
    names = ["doc_id", "target", "n_words", "ce_target", "ce_background"]

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        c = chunk.to_pylist()[0]
        found = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        words, pairs = ([np.concatenate([np.empty(0, U), *[unpack(r[x]) for r in found if r["kind"] == kind]]).astype(np.int64) for x in TOTALS]
                        for kind in (WORDS, PAIRS))
        n = np.array(c["n"], dtype=np.int64)
        ce = losses(c["target"], n, unpack_sorted(c["words"]), unpack(c["places"]).astype(np.int64), words, pairs, total, size, p)
        return pa.table([pa.array(c["doc_ids"], pa.int64()), pa.array([c["target"]] * len(n), pa.bool_()), pa.array(n),
                         *[pa.array(x, pa.float64(), mask=n == 0) for x in ce]], names=names)

    out = model.chunked.groupBy("chunk").cogroup(model.answers.groupBy("chunk")).applyInArrow(
        run, "doc_id long, target boolean, n_words long, ce_target double, ce_background double")
    return out.withColumn("score", F.col("ce_target") - F.col("ce_background"))


def op1_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    """Losses and their difference for every document."""
    rows = flagged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(rows, train(rows)).select("doc_id", "target", "n_words", *[F.round(c, 6).alias(c) for c in ("ce_target", "ce_background", "score")])


#: Equal to op1 at any size; doubles are compared after rounding.
OP1_SQL = r"""
WITH good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
src AS (SELECT row_number() OVER () AS r, d.doc_id, g.doc_id IS NOT NULL AS target,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents d LEFT JOIN good g ON d.doc_id = g.doc_id),
tok AS (SELECT r, target, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM src),
tot AS (SELECT count(*) FILTER (target) AS nt, count(*) FILTER (NOT target) AS nb, count(*) AS n FROM tok),
sc AS (SELECT nt, nb, n, least(nt, nb) / greatest(nt, 1)::DOUBLE AS st, least(nt, nb) / greatest(nb, 1)::DOUBLE AS sb FROM tot),
vocab AS (SELECT w, row_number() OVER (ORDER BY w) AS id FROM tok GROUP BY w),
ids AS (SELECT r, target, i, coalesce(id, 0) AS id, lag(coalesce(id, 0)) OVER (PARTITION BY r ORDER BY i) AS h
        FROM tok LEFT JOIN vocab USING (w)),
uni AS (SELECT id, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS b FROM ids GROUP BY id),
size AS (SELECT count(*) + 1 AS v FROM vocab),
pairs AS (SELECT h, id, count(*) FILTER (target) AS t, count(*) FILTER (NOT target) AS b FROM ids WHERE h IS NOT NULL GROUP BY h, id),
ctx AS (SELECT h, sum(t)::BIGINT AS t, sum(b)::BIGINT AS b FROM pairs GROUP BY h),
ow AS (SELECT r, id, count(*) AS m FROM ids GROUP BY r, id),
op AS (SELECT r, h, id, count(*) AS m FROM ids SEMI JOIN pairs USING (h, id) GROUP BY r, h, id),
oc AS (SELECT r, h, sum(m)::BIGINT AS m FROM op GROUP BY r, h),
ln AS (SELECT r, count(*) AS m FROM ids GROUP BY r),
x AS (SELECT ids.r, ids.h,
        ((uni.t - if(target, ow.m, 0)) * st + 0.5::DOUBLE) / ((nt - if(target, ln.m, 0)) * st + 0.5::DOUBLE * v) AS ut,
        ((uni.b - if(target, 0, ow.m)) * sb + 0.5::DOUBLE) / ((nb - if(target, 0, ln.m)) * sb + 0.5::DOUBLE * v) AS ub,
        (coalesce(pairs.t, 0) - if(target, coalesce(op.m, 0), 0)) * st AS pt,
        (coalesce(pairs.b, 0) - if(target, 0, coalesce(op.m, 0))) * sb AS pb,
        (coalesce(ctx.t, 0) - if(target, coalesce(oc.m, 0), 0)) * st AS ct,
        (coalesce(ctx.b, 0) - if(target, 0, coalesce(oc.m, 0))) * sb AS cb
      FROM ids JOIN uni ON ids.id = uni.id JOIN ow ON ids.r = ow.r AND ids.id = ow.id JOIN ln ON ids.r = ln.r
      LEFT JOIN pairs ON ids.h = pairs.h AND ids.id = pairs.id LEFT JOIN ctx ON ids.h = ctx.h
      LEFT JOIN op ON ids.r = op.r AND ids.h = op.h AND ids.id = op.id LEFT JOIN oc ON ids.r = oc.r AND ids.h = oc.h,
      sc, size),
ce AS (SELECT r, avg(-ln(if(h IS NULL, ut, (pt + 20.0::DOUBLE * ut) / (ct + 20.0::DOUBLE)))) AS ce_target,
              avg(-ln(if(h IS NULL, ub, (pb + 20.0::DOUBLE * ub) / (cb + 20.0::DOUBLE)))) AS ce_background FROM x GROUP BY r)
SELECT doc_id, target, len(w)::BIGINT AS n_words, round(ce_target, 6) AS ce_target, round(ce_background, 6) AS ce_background,
       round(ce_target - ce_background, 6) AS score
FROM src LEFT JOIN ce USING (r)
"""
