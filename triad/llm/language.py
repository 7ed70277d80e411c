"""Language identification by bit-sliced Bloom filters of character n-grams.

Training counts every n-gram of every training text by language (summed in the
tasks, then by Spark).  A language owns every n-gram that it has ``least`` times or
more, unless the n-gram's share of the language is under ``stray`` of its share of
another one: so stray words of other languages stay out, and no n-gram goes because the
corpus grows.  All filters lie in one table: a slot is a word with a bit for each
language, and the AND of an n-gram's slots is the set of languages that contain it.
Spark sets the bits (by slot, combined map-side) and only the finished table is gathered: it
has as many slots as the language with most n-grams needs for ``wrong`` false positives, up
to ``most_slots``, which bounds what is broadcast; beyond that no n-gram is left
out, only the rate of false positives rises.  A text's score for a language is the share of its
n-grams with that bit, corrected for the filter's false positives
((share - rate) / (1 - rate)); the largest wins.

An n-gram is ``order`` characters of a word in lower case, with a blank before
and after the word; words are runs of letters.

Defined results: null text or one without letters is ``und`` with score 0.  Text
whose n-grams no language owns, and ties, go to the first language by name.
Training leaves out rows without lang or doc_id; if nothing can be learned, every
prediction is ``und``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, cut, mix, slices
from triad.llm.words import PLACES


@dataclass(frozen=True)
class Filters:
    order: int = 4
    least: int = 2               # occurrences of an n-gram in a language that owns it
    stray: float = 0.02
    wrong: float = 0.01          # false positives of the fullest filter
    hashes: int = 3
    slots: int = 1 << 21         # a power of two; learn() sets it
    most_slots: int = 1 << 25

    def sized(self, grams: int) -> "Filters":
        need = -self.hashes * grams / math.log1p(-self.wrong ** (1 / self.hashes))
        return replace(self, slots=min(self.most_slots, 1 << max(12, math.ceil(math.log2(max(need, 1))))))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, and the text that each is from."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer(" ".join(["", *(f"{t} " for t in low)]).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) + 2 for t in low])
    code = code[:len(owner)]
    is_letter = letters()[code]
    keep = is_letter | np.r_[True, is_letter[:-1]] | np.r_[True, owner[1:] != owner[:-1]]
    code, owner, is_letter = np.where(is_letter, code, np.uint32(32))[keep].astype(np.uint64), owner[keep], is_letter[keep]
    m = len(code) - order + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inner = np.ones(m, dtype=bool)
    for i in range(1, order - 1):
        inner &= is_letter[i:i + m]
    h = code[:m] * PLACES[0]
    for i in range(1, order):
        h = h + code[i:i + m] * PLACES[i]
    return mix(h[inner]), owner[:m][inner]


def counts(docs: DataFrame, f: Filters) -> DataFrame:
    """lang, gram, n over the texts of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                gram, n = summed(parts)
                for i in range(0, len(gram), 1 << 18):
                    g = gram[i:i + (1 << 18)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n[i:i + (1 << 18)])],
                                                     names=["lang", "gram", "n"])
            held.clear()

        for b in slices(batches, "text"):
            texts, langs = b.column("text").to_pylist(), np.array(b.column("lang").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                gram, _ = ngrams([texts[i] for i in np.flatnonzero(langs == lang)], f.order)
                held[lang].append(np.unique(gram, return_counts=True))
                size += len(held[lang][-1][0])
                if len(held[lang]) >= 8:
                    parts = held[lang]
                    held[lang] = [summed(parts)]
                    size += len(held[lang][0][0]) - sum(len(p[0]) for p in parts)
            if size > 4_000_000:
                yield from out()
                size = 0
        yield from out()

    rows = docs.mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.zeros(len(gram), dtype=np.int64)
    np.add.at(n, at, np.concatenate([p[1] for p in parts]))
    return gram, n


class Sliced:
    """The filters of all languages in one table; 64 languages to a word."""

    def __init__(self, owned: dict[str, np.ndarray], f: Filters):
        self.shape(sorted(owned), f)
        for i, lang in enumerate(self.langs):
            mask = self.kind(1) << self.bit[i][1]
            for s in self.spots(owned[lang]):
                self.tables[self.bit[i][0]][s] |= mask  # equal spots set the same bit
        self.measure()

    @classmethod
    def of_slots(cls, langs: list[str], slot: np.ndarray, word: np.ndarray, mask: np.ndarray, f: Filters) -> "Sliced":
        """From the table's words of 64 languages as Spark has summed them."""
        self = cls.__new__(cls)
        self.shape(langs, f)
        for w, table in enumerate(self.tables):
            here = word == w
            table[slot[here]] = mask[here].view(np.uint64).astype(self.kind)
        self.measure()
        return self

    def shape(self, langs: list[str], f: Filters) -> None:
        self.f, self.langs = f, langs
        self.kind = next((t for t in (np.uint8, np.uint16, np.uint32) if len(langs) <= np.iinfo(t).bits), np.uint64)
        bits = np.iinfo(self.kind).bits
        self.tables = [np.zeros(f.slots, dtype=self.kind) for _ in range(0, len(langs), bits)]
        self.bit = [(i // bits, self.kind(i % bits)) for i in range(len(langs))]

    def measure(self) -> None:
        """The rate of false positives of each language's filter."""
        full = [np.count_nonzero(self.tables[t] & (self.kind(1) << b)) for t, b in self.bit]
        self.rate = (np.array(full, dtype=float) / self.f.slots) ** self.f.hashes

    def spots(self, gram: np.ndarray) -> Iterator[np.ndarray]:
        low, step = gram & np.uint64(0xFFFFFFFF), (gram >> np.uint64(32)) | np.uint64(1)
        for i in range(self.f.hashes):
            yield ((low + np.uint64(i) * step) & np.uint64(self.f.slots - 1)).astype(np.int64)

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """texts x languages corrected shares, and the number of n-grams by text."""
        gram, owner = ngrams(texts, self.f.order)
        total = np.bincount(owner, minlength=len(texts))
        at = list(self.spots(gram))
        found = []
        for table in self.tables:
            mask = table[at[0]]
            for s in at[1:]:
                mask &= table[s]
            found.append(mask)
        out = np.zeros((len(texts), len(self.langs)))
        for i, (t, bit) in enumerate(self.bit):
            out[:, i] = np.bincount(owner[(found[t] >> bit) & found[t].dtype.type(1) > 0], minlength=len(texts))
        out /= np.maximum(total, 1)[:, None]
        return np.clip((out - self.rate) / np.maximum(1 - self.rate, 1e-9), 0.0, 1.0), total


def learn(docs: DataFrame, f: Filters = Filters()) -> Sliced:
    """The filters of the languages of ``docs`` (text, lang)."""
    rows = columns(docs, lang="string", text="string").where("lang is not null and text is not null")
    n = cut(counts(rows, f))
    part = F.col("n") / F.col("all")
    n = n.join(n.groupBy("lang").agg(F.sum("n").alias("all")), "lang").select("lang", "gram", "n", part.alias("part"))
    best = n.groupBy("gram").agg(F.max("part").alias("best"))
    owned = cut(n.join(best, "gram").where((F.col("n") >= f.least) & (F.col("part") >= F.col("best") * f.stray)).select("lang", "gram"))
    sizes = {r["lang"]: r["n"] for r in owned.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    f = f.sized(max(sizes.values(), default=0))
    place = docs.sparkSession.createDataFrame([(x, i // 64, i % 64) for i, x in enumerate(langs)], "lang string, word int, bit int")
    low, step = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    slot = F.explode(F.array(*[(low + i * step).bitwiseAND(F.lit(f.slots - 1)) for i in range(f.hashes)]))
    table = owned.join(F.broadcast(place), "lang").select(slot.alias("slot"), "word", F.expr("shiftleft(1L, bit)").alias("mask"))
    # one row for each used slot and 64 languages
    table = table.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    return Sliced.of_slots(langs, *[table[c].to_numpy() for c in ("slot", "word", "mask")], f)


def predict(docs: DataFrame, model: Sliced) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text", 2 << 20):
            texts = b.column("text").to_pylist()
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            if m.langs:
                share, total = m.shares(texts)
                best = share.argmax(axis=1)
                score = share.max(axis=1) / np.maximum(share.sum(axis=1), 1e-12)
                # a single letter is too short for an n-gram but still a letter
                has = [n > 0 or any(map(str.isalpha, t or "")) for n, t in zip(total, texts, strict=True)]
                pred = [m.langs[i] if ok else "und" for i, ok in zip(best, has, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.where(np.array(pred) == "und", 0.0, score))],
                                             names=["doc_id", "lang_pred", "score"])

    return columns(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 4


def op6_bitsliced_langid(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the other folds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(fold() != 2))
    return predict(docs, model).select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
