"""Benchmark decontamination by greedy string tiling.

Items are word sequences; a seed is a window of ``seed`` words.  Each document's
windows are joined with the items' seeds.  For every item that shares one, equal
windows along a diagonal grow into maximal matches (running Karp-Rabin, with the
words themselves compared), and the longest match whose words are unmarked on
both sides is marked again and again until none of ``seed`` words is left.  Tiles
may come in any order, so reordered passages count.  An item of which at least
``percent`` of the words lie in tiles has leaked.

The benchmark is a query set: it is cut into blocks of about ``block_words``
words by a hash of its rows, each block's index is at most that large, and every
block is run against all documents.  A seed that many items share would make each
of them a candidate in every document with that phrase; so an item is tiled only
if the document has one of its rarer seeds, where the common ones together cannot
reach ``percent``.

Defined results: words are runs of letters and digits in lower case.  Null or
empty texts and items with fewer than ``seed`` words match nothing.  Equal items
are found each; every row of a repeated doc_id gives its own rows.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, slices, with_decision
from triad.llm.words import windows

WORD = re.compile(r"\w+")
SCHEMA = ("doc_id long, item_id long, n_words long, covered long, n_tiles long, "
          "tiles array<struct<doc_word: long, item_word: long, words: long>>, text_hash long")


@dataclass(frozen=True)
class Tiling:
    seed: int = 5
    percent: int = 50
    block_words: int = 1_000_000


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Index:
    """Vocabulary and seeds of one block of items."""

    def __init__(self, items: list[tuple[int, list[str]]], p: Tiling):
        self.p = p
        items = [(i, w) for i, w in items if len(w) >= p.seed]
        self.vocabulary: dict[str, int] = {}
        for _, words in items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.ids = [i for i, _ in items]
        self.words = [np.array([self.vocabulary[w] for w in ws], dtype=np.uint64) for _, ws in items]
        self.seeds = [windows(w, p.seed).tolist() for w in self.words]
        often = Counter(s for seeds in self.seeds for s in set(seeds))
        self.rare: dict[int, list[int]] = defaultdict(list)
        for k, seeds in enumerate(self.seeds):
            for s in set(seeds) - self.common(seeds, often, len(self.words[k])):
                self.rare[s].append(k)
        self.sorted = np.array(sorted(often), dtype=np.uint64)

    def common(self, seeds: list[int], often: Counter, n: int) -> set[int]:
        """The most shared seeds, as far as their words alone stay below the threshold."""
        out, marked = set(), set()
        for s in sorted((s for s in set(seeds) if often[s] > 1), key=lambda s: (-often[s], s)):
            marked |= {i + j for i, x in enumerate(seeds) if x == s for j in range(self.p.seed)}
            if 100 * len(marked) >= self.p.percent * n:
                break
            out.add(s)
        return out

    def numbers(self, words: list[str]) -> np.ndarray:
        """Word numbers; 0 for words that no item has."""
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=len(words))

    def hits(self, doc: np.ndarray) -> dict[int, list[int]]:
        """Seeds of the block in the document, with their places."""
        n = self.p.seed
        if len(doc) < n or not len(self.sorted):
            return {}
        known = np.concatenate([[0], np.cumsum(doc > 0)])
        at = np.flatnonzero(known[n:] - known[:-n] == n)
        if not len(at):
            return {}
        found = windows_at(doc, at, n)
        spot = np.minimum(np.searchsorted(self.sorted, found), len(self.sorted) - 1)
        out = defaultdict(list)
        for i in np.flatnonzero(self.sorted[spot] == found):
            out[int(found[i])].append(int(at[i]))
        return out

    def leaks(self, words: list[str]) -> list[tuple]:
        doc = self.numbers(words)
        hits = self.hits(doc)
        out = []
        for k in sorted({k for s in hits for k in self.rare.get(s, ())}):
            tiles = tile(doc, self.words[k], self.seeds[k], hits, self.p.seed)
            covered = sum(t[2] for t in tiles)
            if 100 * covered >= self.p.percent * len(self.words[k]):
                out.append((self.ids[k], len(self.words[k]), covered, len(tiles), tiles))
        return out


def windows_at(doc: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The hashes of ``windows`` for the windows that begin at ``at`` alone."""
    return windows(doc[at[:, None] + np.arange(n)].ravel(), n)[::n]


def matches(doc: np.ndarray, item: np.ndarray, seeds: list[int], hits: dict[int, list[int]], n: int) -> list[tuple]:
    """Maximal equal runs of n words and more as (length, place in the item, place in the document)."""
    pairs = sum(len(hits.get(s, ())) for s in seeds)
    if pairs > len(doc) + len(item):
        return all_matches(doc, item, n)
    runs, out = {}, []  # by diagonal: [item start, doc start, length]
    for i, s in enumerate(seeds):
        for d in hits.get(s, ()):
            if not np.array_equal(doc[d:d + n], item[i:i + n]):
                continue
            run = runs.get(d - i)
            if run and run[0] + run[2] == i + n - 1:
                run[2] += 1
            else:
                if run:
                    out.append((run[2], run[0], run[1]))
                runs[d - i] = [i, d, n]
    return out + [(r[2], r[0], r[1]) for r in runs.values()]


def all_matches(doc: np.ndarray, item: np.ndarray, n: int) -> list[tuple]:
    """The same where words repeat so much that the pairs of places outnumber the words: the
    lengths of the equal runs that end at a word of the item, for all places of the
    document at once, follow from those of the word before."""
    out = []
    before = np.zeros(len(doc) + 1, dtype=np.int64)          # runs that end at the item's last word, by end in the document
    for i in range(len(item) + 1):
        now = np.zeros_like(before)
        if i < len(item):
            now[1:] = np.where(doc == item[i], before[:-1] + 1, 0)
        # runs that no longer word goes on
        ended = np.flatnonzero((before >= n) & (np.r_[now[1:], 0] == 0))
        out += [(m, i - m, d - m) for d, m in zip(ended.tolist(), before[ended].tolist(), strict=True)]
        before = now
    return out


def tile(doc: np.ndarray, item: np.ndarray, seeds: list[int], hits: dict[int, list[int]], n: int) -> list[tuple]:
    """Greedy tiles (document word, item word, words): longest first, then by place."""
    heap = [(-m, i, d) for m, i, d in matches(doc, item, seeds, hits, n)]
    heapq.heapify(heap)
    in_item, in_doc, out = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool), []
    while heap:
        m, i, d = heapq.heappop(heap)
        taken = in_item[i:i - m] | in_doc[d:d - m]
        if not taken.any():
            in_item[i:i - m] = in_doc[d:d - m] = True
            out.append((d, i, -m))
            continue
        edge = np.diff(np.concatenate(([1], taken.view(np.int8), [1])))
        for a, b in zip(np.flatnonzero(edge == -1).tolist(), np.flatnonzero(edge == 1).tolist(), strict=True):
            if b - a >= n:
                heapq.heappush(heap, (a - b, i + a, d + a))
    return sorted(out)


def blocks(benchmark: DataFrame, p: Tiling) -> Iterator[list[tuple[int, list[str]]]]:
    """The items, block by block."""
    items = columns(benchmark, item_id="long", text="string").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // (6 * p.block_words))
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))
    for k in range(n):
        yield [(r.item_id, tokens(r.text)) for r in items.where(spread == k).collect()]


def against(docs: DataFrame, index: Index) -> DataFrame:
    """The leaks of one block's items in every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = []
            for doc_id, text, text_hash in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "text_hash")), strict=True):
                rows += [(doc_id, *x, text_hash) for x in index.leaks(tokens(text))]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            span = pa.list_(pa.struct([(x, pa.int64()) for x in ("doc_word", "item_word", "words")]))
            tiles = [[{"doc_word": d, "item_word": i, "words": m} for d, i, m in t] for t in cols[5]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(tiles, span), pa.array(cols[6], pa.int64())],
                names=["doc_id", "item_id", "n_words", "covered", "n_tiles", "tiles", "text_hash"])

    return columns(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, p: Tiling = Tiling()) -> DataFrame:
    """One row for each row of ``docs`` and each item that leaked into it."""
    found = [against(docs, Index(items, p)) for items in blocks(benchmark, p)]
    return reduce(DataFrame.unionByName, found) if found else against(docs, Index([], p))


def op4_string_tiling(spark, sf_dir: str) -> DataFrame:
    """The (doc_id, item_id) leaks with words, covered words and tiles."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_words", "covered", "n_tiles",
                        (F.col("covered") / F.col("n_words")).alias("coverage"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, p: Tiling = Tiling()) -> DataFrame:
    """``docs`` without the rows into which an item has leaked."""
    return with_decision(docs, leaks(docs, benchmark, p).select("doc_id", "text_hash"))
