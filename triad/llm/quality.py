"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document gives exact counts of its words, symbols and repetitions
(``text_counts``).  Five variance-stabilised, shrunk shares of these counts form
its statistic vector.  For every (lang, source) group the minimum-covariance-
determinant estimate is found by concentration steps: distances under the
current mean and covariance, the ``share`` of smallest distances, mean and
covariance of those rows, and again.  A concentration step is two Spark
aggregations over all rows: a histogram of the logarithm of the distance, whose
cumulative count gives the radius holding at least ``share`` of the group, and
sums of products of the rows within it.  Both combine on the map side, so a hot
group costs what its rows cost and no group is ever gathered.  Two starts (all
rows; coordinatewise medians and quartile ranges) run together and the smaller
determinant wins.

Defined results.  Null or empty text: all counts 0, ``base_failed`` true,
``kept`` false.  Null lang or source is a value like any other.  Groups with
fewer than ``least`` usable rows share one pooled group of their language, and
languages with fewer than ``least`` share one pool of all.  Repeated rows count
as often as they occur.  A pool too small for the shape of its covariance still
has the floor variances, so its rows are judged by those.  Empty tables give
empty results.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triad.llm.common import WHITE, columns, cut, raw, slices, with_decision

SYMBOLS = b"#*$%&|<>"
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_other")
#: Standard deviations below which no statistic is taken to vary: log word
#: length, then arcsine roots of the symbol, repeated line, repeated word and
#: non-letter shares.
FLOORS = (0.05, 0.05, 0.20, 0.20, 0.12)
DIM = len(FLOORS)
X = [f"x{i}" for i in range(DIM)]
GROUP_BROADCAST_ROWS = 10_000


@dataclass(frozen=True)
class Mcd:
    share: float = 0.75          # of a group's rows within the concentration subset
    steps: int = 5
    least: int = 100             # rows for an estimate of a group's own
    tail: float = 1e-5           # chi-square tail beyond which a vector is rejected
    min_words: int = 10
    max_repeat_percent: int = 20


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words inside an ``n``-word window that occurs twice or more."""
    grams = list(zip(*(words[i:] for i in range(n)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    twice = {g for g, c in Counter(grams).items() if c > 1}
    total = end = 0
    for i, g in enumerate(grams):
        if g in twice:
            total += i + n - max(i, end)
            end = i + n
    return total


def count_text(text: bytes | None) -> tuple[int, ...]:
    """COUNTS of one text; words are runs of anything but ASCII white space."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    bare = text.translate(None, WHITE)
    chars = len(bare.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    wide = len(bare.translate(None, bytes(range(128))).decode("utf-8", "replace"))
    other = chars - wide - (len(bare) - len(bare.translate(None, LETTERS)))
    return (len(words), chars, len(bare) - len(bare.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), other)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, text_hash and COUNTS of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = np.array([count_text(t) for t in raw(b, "text")], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "lang", "source", "text_hash")] + [pa.array(found[:, i]) for i in range(len(COUNTS))],
                names=["doc_id", "lang", "source", "text_hash", *COUNTS])

    src = columns(docs, doc_id="long", lang="string", source="string", text="string").withColumn("text_hash", F.xxhash64("text"))
    return src.mapInArrow(run, "doc_id long, lang string, source string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed(p: Mcd) -> Column:
    return (F.col("n_words") < p.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * p.max_repeat_percent)


def vectors(counts: DataFrame) -> DataFrame:
    """The statistic vector x0..x4.  Constants in the ratios shrink short texts
    towards the ordinary value, so that their wider chance spread is no outlier."""

    def root(part: str, whole: str, k: int) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / (F.col(whole) + F.lit(float(k))))))

    xs = (F.log((F.col("word_chars") + 275.0) / (F.col("n_words") + 50.0)), root("n_symbols", "word_chars", 50),
          root("n_dup_lines", "n_lines", 5), root("n_repeat_words", "n_words", 50), root("n_other", "word_chars", 100))
    return counts.select("*", *[x.alias(n) for x, n in zip(xs, X, strict=True)])


def pooled(rows: DataFrame, least: int) -> DataFrame:
    """``gid`` for every (lang, source) with rows: the group, its language's pool
    or the pool of all, whichever is the first to have ``least`` rows."""
    by = (F.coalesce(F.concat(F.lit("l:"), "lang"), F.lit("-")), F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("-")))
    n = rows.groupBy("lang", "source").agg(F.sum(F.when(F.col("usable"), 1).otherwise(0)).alias("n"))
    small = F.when(F.col("n") < least, F.col("n")).otherwise(0)
    n = n.withColumn("pool", F.sum(small).over(Window.partitionBy("lang")))
    return n.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
                    F.when(F.col("n") >= least, F.concat_ws("\x1f", *by))
                    .when(F.col("pool") >= least, by[0]).otherwise(F.lit("*")).alias("gid"))


def attach(rows: DataFrame, small: DataFrame, on, n_small: int, how: str = "inner") -> DataFrame:
    """Join a per-group table: broadcast only when its counted rows are few."""
    return rows.join(F.broadcast(small) if n_small <= GROUP_BROADCAST_ROWS else small, on, how)


def quadratic() -> Column:
    """Squared Mahalanobis distance of x under center m and precision q."""
    out = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            term = (F.col(X[i]) - F.col("m")[i]) * (F.col(X[j]) - F.col("m")[j]) * F.col("q")[i * DIM + j]
            out = out + (term if i == j else term * 2.0)
    return F.greatest(out, F.lit(0.0))


BIN = 16.0  # bins for each doubling of the squared distance
LEAST_D2 = 1e-6


def distance_bin() -> Column:
    return F.floor(F.log2(F.greatest(F.col("d2"), F.lit(LEAST_D2))) * BIN).cast("int")


def radius(hist: DataFrame, share: float) -> DataFrame:
    """Per gid and start: the first bin at which ``share`` of the rows is reached."""
    w = Window.partitionBy("gid", "start")
    cum = hist.select("*", F.sum("n").over(w.orderBy("bin")).alias("cum"), F.sum("n").over(w).alias("all"))
    return cum.where(F.col("cum") >= F.col("all") * share).groupBy("gid", "start").agg(F.min("bin").alias("bin"))


def moments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gid", "start").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x) for x in X]).alias("s"),
        F.array(*[F.sum(F.col(X[i]) * F.col(X[j])) for i in range(DIM) for j in range(DIM)]).alias("ss"))


ESTIMATE = "gid string, start int, m array<double>, q array<double>, logdet double"


def invert(m: np.ndarray, cov: np.ndarray) -> tuple[list, list, float]:
    cov = cov + np.diag(np.square(FLOORS))
    return m.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def estimates(sums: DataFrame) -> DataFrame:
    """Mean, precision and log-determinant from each group's sums."""

    def run(frames):
        for f in frames:
            out = []
            for r in f.itertuples():
                m = np.array(r.s) / r.n
                out.append((r.gid, r.start, *invert(m, np.array(r.ss).reshape(DIM, DIM) / r.n - np.outer(m, m))))
            yield f.iloc[:0].reindex(columns=["gid", "start", "m", "q", "logdet"]) if not out else type(f)(
                out, columns=["gid", "start", "m", "q", "logdet"])

    return sums.mapInPandas(run, ESTIMATE)


def median_start(z: DataFrame, grain: float = 0.01) -> DataFrame:
    """Start 1: medians and quartile ranges from a histogram of each coordinate."""
    hist = z.select("gid", F.posexplode(F.array(*[F.floor(F.col(x) / grain) for x in X])).alias("k", "bin"))
    hist = hist.groupBy("gid", "k", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("gid", "k")
    cum = hist.select("*", F.sum("n").over(w.orderBy("bin")).alias("cum"), F.sum("n").over(w).alias("all"))

    def at(s: float) -> Column:
        return F.min(F.when(F.col("cum") >= F.col("all") * s, (F.col("bin") + 0.5) * grain))

    q = cum.groupBy("gid", "k").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    q = q.groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("k", "mid", "sd"))).alias("a"))

    def run(frames):
        for f in frames:
            rows = [(r.gid, 1, *invert(np.array([x["mid"] for x in r.a]), np.diag([x["sd"] ** 2 for x in r.a])))
                    for r in f.itertuples()]
            yield type(f)(rows, columns=["gid", "start", "m", "q", "logdet"])

    return q.mapInPandas(run, ESTIMATE)


def chi_square(p: float, k: int) -> float:
    """Quantile by the Wilson-Hilferty cube."""
    z = NormalDist().inv_cdf(p)
    return k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


def fit(z: DataFrame, p: Mcd) -> DataFrame:
    """gid, m, q and ``scale`` of the least-determinant estimate of each group.

    z: gid and x0..x4 of the usable rows.  ``scale`` makes the distances
    consistent at the normal model and never shrinks the floor variances."""
    z = cut(z.select("gid", *X))
    n = z.select("gid").distinct().count()
    est = cut(estimates(moments(z.withColumn("start", F.lit(0)))).unionByName(median_start(z)))
    for _ in range(p.steps):
        near = attach(z, est.drop("logdet"), "gid", 2 * n).withColumn("d2", quadratic())
        near = near.select("gid", "start", *X, distance_bin().alias("bin"))
        at = radius(near.groupBy("gid", "start", "bin").agg(F.count(F.lit(1)).alias("n")), p.share)
        inside = attach(near, at.withColumnRenamed("bin", "most"), ["gid", "start"], 2 * n)
        est = cut(estimates(moments(inside.where(F.col("bin") <= F.col("most")))))
    first = Window.partitionBy("gid").orderBy(F.round("logdet", 6), "start")
    est = est.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank", "logdet")
    near = attach(z, est, "gid", n).withColumn("d2", quadratic()).select("gid", "start", distance_bin().alias("bin"))
    at = radius(near.groupBy("gid", "start", "bin").agg(F.count(F.lit(1)).alias("n")), p.share)
    ratio = F.pow(F.lit(2.0), (F.col("bin") + 1) / BIN) / chi_square(p.share, DIM)
    scale = at.select("gid", F.greatest(F.lit(1.0), ratio).alias("scale"))
    return cut(est.drop("start").join(scale, "gid"))


def judged(docs: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, source, text_hash, COUNTS, ``base_failed``,
    ``distance`` (squared, scaled) and ``kept``."""
    rows = cut(text_counts(docs).withColumn("usable", ~base_failed(p)))
    groups = cut(pooled(rows, p.least))
    n = groups.count()
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    z = vectors(attach(rows, groups, same, n).drop("g_lang", "g_source"))
    est = fit(z.where("usable"), p)
    out = attach(z, est, "gid", n, "left").withColumn("d2", quadratic() / F.col("scale"))
    ok = F.col("usable") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= chi_square(1 - p.tail, DIM))
    return out.select("doc_id", "lang", "source", "text_hash", *COUNTS, (~F.col("usable")).alias("base_failed"),
                      F.col("d2").alias("distance"), ok.alias("kept"))


def op2_mcd_outliers(spark, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the distance of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs).select("doc_id", *COUNTS[:5], "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, p: Mcd = Mcd()) -> DataFrame:
    """``docs`` without the rejected rows."""
    return with_decision(docs, judged(docs, p).where(~F.col("kept")).select("doc_id", "lang", "source", "text_hash"))
