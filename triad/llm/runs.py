"""Periodic runs of words, found through string synchronising sets.

A run is a maximal stretch of words with smallest period q and at least 3q words.
For each dyadic scale t, positions are selected by hash: position i is kept if the
least hash among the t-word windows that begin at i .. i+t is the one at i or at
i+t, windows that themselves have a period of t/3 or less being left out.  The
choice depends on the 2t words from i on alone, so where a run repeats itself the
same positions are kept again: two kept positions with equal 2t-word contexts, 2t
to 4t words apart, propose their distance as a period.  A run of period q in
[2t, 4t) has q + 1 places for such a position and q words to the right of it, and
cannot consist of windows left out (it would have the shorter period throughout),
so it is always proposed.  Hashes only propose: every run is extended and
compared on the words themselves.

The windows left out lie in runs of period t/3 or less.  These are known when
scale t begins: those of up to SMALL words from comparing the text with itself
shifted by 1 .. SMALL words, the others from smaller scales.

Each task works on all texts of a batch laid end to end, longest first, with a
separator unlike anything behind each; scale t reads only the texts of 6t words
and more.  Nothing is shuffled, and work grows as n log n with a text's words.

Defined results.  Null and empty texts have no words and no runs.  Words are
separated by blanks, tabs, line ends, vertical tabs and form feeds only, and are
compared byte by byte.  Repeated rows each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, documents, mix, raw, slices
from triad.llm.words import PLACES

SMALL = 7                        # periods found by shifting; scales begin at 4 words
LEAST = 24                       # shortest run returned
NONE = np.uint64(2**64 - 1)


def stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def prime_factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] if n > 1 else out


def shifted_runs(x: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """(start, end, q) of the runs of a small smallest period q."""
    begin, end = stretches(x[:-q] == x[q:])
    keep = end - begin >= 2 * q
    begin, end = begin[keep], end[keep] + q
    for f in prime_factors(q):
        place = begin[:, None] + np.arange(q)
        shorter = (x[place] == x[place + q // f]).all(axis=1)
        begin, end = begin[~shorter], end[~shorter]
    return [(int(b), int(e), q) for b, e in zip(begin, end, strict=True)]


def extend(x: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch around ``i`` in which each word equals the one q further."""
    last, step, hi = len(x) - q, 64, i
    while hi < last:
        stop = min(hi + step, last)
        same = x[hi:stop] == x[hi + q:stop + q]
        if not same.all():
            hi += int(same.argmin())
            break
        hi, step = stop, 2 * step
    step, lo = 64, i
    while lo > 0:
        stop = max(lo - step, 0)
        same = x[stop:lo] == x[stop + q:lo + q]
        if not same.all():
            lo -= int(same[::-1].argmin())
            break
        lo, step = stop, 2 * step
    return lo, hi


def synchronising(low: np.ndarray, t: int) -> np.ndarray:
    """Positions whose window, or the one t further, has the least hash of all from one to the other."""
    least, s = low, 1
    while s < t:
        least = np.minimum(least[:-s], least[s:])
        s *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero(((least == low[:n]) | (least == low[t:t + n])) & (least != NONE))


def proposals(context: np.ndarray, kept: np.ndarray, t: int) -> np.ndarray:
    """Distinct (distance, position), sorted: kept positions with equal contexts 2t to 4t apart
    that begin a square."""
    order = np.argsort(context[kept], kind="stable")
    pos, key = kept[order], context[kept][order]
    found, step = [np.empty((0, 2), dtype=np.int64)], 1
    while step < len(pos):
        apart = pos[step:] - pos[:-step]
        near = (key[step:] == key[:-step]) & (apart < 4 * t)
        if not near.any():
            break
        near &= apart >= 2 * t
        found.append(np.stack([apart[near], pos[:-step][near]], axis=1))
        step += 1
    pairs = np.concatenate(found)
    tail = pairs[:, 1] + pairs[:, 0] - 2 * t
    pairs, tail = pairs[tail + pairs[:, 0] < len(context)], tail[tail + pairs[:, 0] < len(context)]
    pairs = pairs[context[tail] == context[tail + pairs[:, 0]]]
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def runs_of(x: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs.  ``x``: word numbers of texts laid end to end,
    longest first, each followed by a number found nowhere else; ``sizes``: their words."""
    runs = [r for q in range(1, SMALL + 1) if len(x) > q for r in shifted_runs(x, q)]
    ends = np.cumsum(sizes + 1)
    h, t, width = mix(x.astype(np.int64)), 4, 1
    while True:
        texts = int(np.searchsorted(-sizes, -6 * t, side="right"))
        if not texts:
            return runs
        m = int(ends[texts - 1])
        x, h = x[:m], h[:m]
        while width < t:
            h = mix(h[:-width] * PLACES[0] + h[width:] * PLACES[1])
            width *= 2
        h = h[:m - t + 1]
        known = np.array([r for r in runs if 3 * r[2] <= t and r[1] - r[0] >= t and r[1] <= m], dtype=np.int64).reshape(-1, 3)
        mark = np.zeros(len(h) + 1, dtype=np.int32)
        np.add.at(mark, known[:, 0], 1)
        np.add.at(mark, known[:, 1] - t + 1, -1)
        low = np.where(np.cumsum(mark[:-1]) > 0, NONE, h)
        context = mix(h[:-t] * PLACES[0] + h[t:] * PLACES[1])
        before, until = 0, 0
        for q, i in proposals(context, synchronising(low, t), t).tolist():
            if q == before and i < until:
                continue
            lo, until = extend(x, i, q)
            before = q
            if until - lo >= 2 * q and not any(np.array_equal(x[lo:lo + q], x[lo + q // f:lo + q // f + q]) for f in prime_factors(q)):
                runs.append((lo, until + q, q))
        t *= 2


def batch_runs(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """For each text its words and the (start, length, period) of its runs of LEAST words and more."""
    words = [(s or b"").split() for s in texts]
    order = sorted(range(len(words)), key=lambda k: -len(words[k]))
    sizes = np.array([len(words[k]) for k in order], dtype=np.int64)
    number: dict[bytes, int] = {}
    x = np.empty(int(sizes.sum()) + len(order), dtype=np.int64)
    at = 0
    for k, n in zip(order, sizes.tolist(), strict=True):
        x[at:at + n] = [number.setdefault(w, len(number)) for w in words[k]]
        x[at + n] = -1 - k
        at += n + 1
    starts = np.cumsum(sizes + 1) - sizes - 1
    found: dict[int, list] = {}
    for b, e, q in runs_of(x, sizes):
        if e - b >= LEAST:
            j = int(np.searchsorted(starts, b, side="right")) - 1
            found.setdefault(order[j], []).append((b - int(starts[j]), e - b, q))
    for k, w in enumerate(words):
        yield w, sorted(found.get(k, ()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one blank."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join(w for w, d in zip(words, np.cumsum(drop).tolist(), strict=False) if not d)


RUN = "struct<start:long,length:long,period:long>"
OUT = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document, see OUT: its runs by start and period, the one with the greatest
    length / period (null without runs; ties: least start, then period), and the text with
    each run cut to its first period."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in slices(batches, "text"):
            size, all_runs, best, kept = [], [], [], []
            for words, runs in batch_runs(raw(batch, "text")):
                size.append(len(words))
                all_runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                best.append(max(all_runs[-1], key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None))
                kept.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(all_runs, pa.list_(run)), pa.array(best, run),
                 pa.array(kept, pa.binary()).cast(pa.string(), safe=False)],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return columns(docs, doc_id="long", text="string").mapInArrow(rows, OUT)


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, in which one text of ten (by the checksum of its doc_id)
    repeats some of its words from a certain word on to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    d = columns(docs, doc_id="long", text="string")
    d = d.withColumn("loop", (h % 10 == 0) & F.col("text").isNotNull()).withColumn("g", g)
    d = d.withColumn("words", F.when(F.col("loop"), words)).withColumn("n", F.size("words"))
    some = F.col("loop") & (F.col("n") > 0)
    a = F.when(some, (F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("a", a).withColumn("p", F.when(some, 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int"))

    def again(n: Column, a: Column, p: Column) -> Column:
        loop = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.concat(F.slice("words", F.lit(1), a), F.slice(loop, F.lit(1), n - a))

    return d.select("doc_id", F.when(some, F.array_join(again(F.col("n"), F.col("a"), F.col("p")), " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which are looped first."""
    found = periodic_runs(looped(documents(spark, sf_dir)))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words")
