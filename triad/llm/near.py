"""MinHash near-duplicates verified by odd sketches.

``signatures`` reduces each document to a 128-bit fingerprint of its shingle set,
band keys of its MinHash samples, and an odd sketch: every sample flips one bit
of a bitmap, so that the XOR of two bitmaps has the parity of what the samples
do not share and its population count estimates the similarity.  Documents with
one fingerprint form a class; only classes go on, so exact copies cost one row.

Classes that share a band key are candidates.  First each bucket's members are
tested against one center, then those of still divided buckets against the member with
most links; a test is the XOR of two odd sketches, and what passes is confirmed on
the full sets.  A group of n near copies costs some n tests so far.  What is left
are buckets with members in more than one component.  Links across components are
found among their members by prefixes: with every set in one order, rare shingles
first, two similar sets share one near their beginnings, and its places bound the
overlap.  Strongly changed copies begin with shingles of their own, so they meet
nobody, however large the group; only pairs at the threshold meet, and pass the
same two tests: first each set with the partner of best estimate, then, where
that did not join their components, with all others.  No pair in a bucket is given
up and none within a component is made.  Components come from alternating star
contractions; no group, component or list of links reaches the driver or a task.
Centers of large stars and large buckets are hot keys; they are joined by
``spread_join``.  Classes are numbered, links are pairs of numbers, and a table
goes when the next one stands.

Defined results.  Words are runs of anything but ASCII white space, A-Z in lower
case.  A text with fewer words than a shingle is one shingle; null, empty or
white texts have no shingles, link with nothing and are kept.  Links join texts,
so rows that repeat a doc_id stand for themselves; ``component_id`` is the
smallest non-null doc_id of the component, ``kept`` says that a row has it.  A
component of only null ids has a null component_id and keeps its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from triad.llm.common import ID_BROADCAST_ROWS, IDENTITY, Tables, columns, cut, mix, raw, slices, spread_join, with_decision
from triad.llm.words import Hashes, shingle_set


@dataclass(frozen=True)
class Near:
    shingle: int = 5
    percent: int = 80            # links: 100 * intersection >= percent * union
    bands: int = 32              # misses a pair at 0.8 with 3e-6, at 0.85 with 7e-9
    rows: int = 5
    words: int = 8               # 64-bit words of an odd sketch
    margin: float = 0.2          # over six standard errors of the estimate

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def samplers(p: Near) -> tuple[np.ndarray, np.ndarray]:
    """A multiplier and an addend for each MinHash sample."""
    seeds = mix(np.arange(1, 2 * p.samples + 1, dtype=np.uint64))
    return (seeds[:p.samples] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), \
        (seeds[p.samples:] >> np.uint64(32)).astype(np.uint32)


def minhash(sets: list[np.ndarray], p: Near) -> np.ndarray:
    """samples x len(sets) minima; no set may be empty."""
    a, b = samplers(p)
    h = (mix(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((p.samples, len(sets)), dtype=np.uint32)
    for j in range(p.samples):
        out[j] = np.minimum.reduceat(h * a[j] + b[j], at)
    return out


def odd_sketches(samples: np.ndarray, p: Near) -> np.ndarray:
    """sets x words parity bitmaps of the samples."""
    k, n = samples.shape
    spot = mix((np.arange(k, dtype=np.uint64)[:, None] << np.uint64(32)) | samples) % np.uint64(64 * p.words)
    out = np.zeros((n, p.words), dtype=np.uint64)
    rows = np.arange(n)
    for j in range(k):
        out[rows, (spot[j] >> np.uint64(6)).astype(np.intp)] ^= np.uint64(1) << (spot[j] & np.uint64(63))
    return out


def band_keys(samples: np.ndarray, p: Near) -> np.ndarray:
    """sets x bands keys."""
    out = np.empty((samples.shape[1], p.bands), dtype=np.uint64)
    for b in range(p.bands):
        key = np.full(samples.shape[1], b + 1, dtype=np.uint64)
        for row in samples[b * p.rows:(b + 1) * p.rows]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        out[:, b] = key
    return out


def lists(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k),
                                    pa.array(values.astype(np.uint64).view(np.int64).ravel()))


def signatures(docs: DataFrame, p: Near) -> DataFrame:
    """doc_id, text_hash, n, node (fingerprint, null without shingles), bands, odd of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Hashes()
        for b in slices(batches, "text", 1 << 20):
            sets = [shingle_set(seen.of((t or b"").lower().split()), p.shingle) for t in raw(b, "text")]
            full = [s for s in sets if len(s)]
            at = pa.array(np.cumsum([len(s) > 0 for s in sets]) - 1, mask=np.array([len(s) == 0 for s in sets]))
            samples = minhash(full, p) if full else np.empty((p.samples, 0), np.uint32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 lists(band_keys(samples, p)).take(at), lists(odd_sketches(samples, p)).take(at)],
                names=["doc_id", "text_hash", "n", "node", "bands", "odd"])

    return columns(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, text_hash long, n long, node binary, bands array<long>, odd array<long>")


def shingle_sets(docs: DataFrame, p: Near) -> DataFrame:
    """print (fingerprint) and the full sorted set of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Hashes()
        for b in slices(batches, "text", 1 << 20):
            sets = [shingle_set(seen.of((t or b"").lower().split()), p.shingle) for t in raw(b, "text")]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["print", "shingles"])

    return docs.mapInArrow(run, "print binary, shingles array<long>")


def odd_estimate(p: Near) -> Column:
    """Similarity from the population count of the XOR of two sketches odd_a and odd_b."""
    bits = 64 * p.words
    z = sum((F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(p.words)), F.lit(0))
    left = F.greatest(F.lit(1.0) - 2.0 * z / bits, F.lit(1e-9))
    return F.lit(1.0) + F.log(left) * (bits / (4.0 * p.samples))


def linked(pairs: DataFrame, sets: DataFrame, p: Near) -> DataFrame:
    """The (a, b) pairs whose odd sketches and then full sets are similar enough.

    A pair that passes the sketches first carries half of each hash: the sets share at
    most what the halves share and what halves are repeated within either set.  What
    passes gets the full sets."""

    def common(x: str, y: str) -> Column:
        return F.size(F.array_intersect(x, y))

    about = pairs
    for k in "ab":
        about = about.join(sets.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("odd").alias(f"odd_{k}")), k)
    about = about.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * p.percent) & (odd_estimate(p) >= p.percent / 100 - p.margin))
    about = about.select("a", "b", "n_a", "n_b")
    half = F.array_distinct(F.transform("shingles", lambda h: h.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    half = sets.select("node", half.alias("half"), (F.col("n") - F.size(half)).alias("twice"))
    for k in "ab":
        about = about.join(half.select(F.col("node").alias(k), F.col("half").alias(f"half_{k}"), F.col("twice").alias(f"twice_{k}")), k)
    most = common("half_a", "half_b") + F.least("twice_a", "twice_b")
    near = about.where(most * 100 >= (F.col("n_a") + F.col("n_b") - most) * p.percent).select("a", "b")
    for k in "ab":
        near = near.join(sets.select(F.col("node").alias(k), F.col("shingles").alias(f"s_{k}")), k)
    same = common("s_a", "s_b")
    return near.where(same * 100 >= (F.size("s_a") + F.size("s_b") - same) * p.percent).select("a", "b")


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def across(rows: DataFrame, p: Near, tables: Tables) -> DataFrame:
    """(a, b, est) pairs of different roots that prefixes and odd sketches leave possible, from
    (node, root, shingles, odd)."""

    def least_of(n: str) -> Column:
        """ceil(n * percent / 100), exactly."""
        return F.floor((F.col(n) * p.percent + 99) / 100)

    def need(n: str, m: str) -> Column:
        """The overlap of sets of n and m shingles that are similar enough."""
        return F.floor(((F.col(n) + F.col(m)) * p.percent + 99 + p.percent) / (100 + p.percent))

    token = rows.select("node", F.explode("shingles").alias("token"))
    often = token.groupBy("token").agg(F.count(F.lit(1)).alias("f"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("f", "token")) - 1
    begin = token.join(often, "token").select("node", "token", place.alias("place"))
    begin = begin.join(rows.select("node", "root", F.size("shingles").alias("n"), "odd"), "node")
    begin = tables.put(begin.where(F.col("place") <= F.col("n") - least_of("n")))
    # of each token: its most frequent root, and the least set that has it
    by = begin.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
    by = by.groupBy("token").agg(F.max(F.struct("k", "root")).alias("most"), F.min("n").alias("least"), F.count(F.lit(1)).alias("roots"))
    by = by.where("roots > 1").select("token", F.col("most.root").alias("major"), "least")
    shared = begin.join(by, "token")

    minor = shared.where((F.col("root") != F.col("major")) & (F.col("n") - F.col("place") >= need("n", "least")))
    x = minor.select("token", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("place").alias("px"),
                     F.col("odd").alias("odd_a"))
    rest = F.least(F.col("nx") - F.col("px"), F.col("n") - F.col("place"))
    fits = F.least("nx", "n") * 100 >= F.greatest("nx", "n") * p.percent
    # two sets of minor roots would meet twice: what fits is minor's on either side
    once = (F.col("root") == F.col("major")) | (F.col("x") < F.col("node"))
    pairs = x.join(shared.withColumnRenamed("odd", "odd_b"), "token")
    pairs = pairs.where((F.col("rx") != F.col("root")) & once & fits & (rest >= need("nx", "n")))
    pairs = pairs.select(*ordered("x", "node"), odd_estimate(p).alias("est")).where(F.col("est") >= p.percent / 100 - p.margin)
    return pairs.groupBy("a", "b").agg(F.max("est").alias("est"))


def stars(edges: DataFrame, tables: Tables) -> DataFrame:
    """(node, root) of every node in a component except its smallest, by
    alternating large-star and small-star steps."""

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("k"))

    e = tables.put(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both).select("a", F.least("a", "m").alias("m"), "k")
        large = spread_join(both, low, ["a"], "k", 2 * now[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.join(least(large).drop("k"), "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        nxt = tables.put(small.select("e.*").where("a != b").distinct())
        tables.drop(e)
        e = nxt


def components(classes: DataFrame, docs: DataFrame, p: Near, tables: Tables) -> DataFrame:
    """(node, root) of every class that is linked with a smaller one."""
    keys = tables.put(classes.select(F.explode("bands").alias("bucket"), "node"))
    center = keys.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("other"), F.count(F.lit(1)).alias("k"))
    center = tables.put(center.where("center != other").select("bucket", "center", "k"))
    live = tables.put(spread_join(keys, center, ["bucket"], "k", keys.count()).where("center IS NOT NULL"))
    tables.drop(keys, center)
    nodes = tables.put(live.select("node").distinct())
    wanted = nodes.join(classes.select("node", "print", "doc_id", "n", "odd"), "node")
    sets = shingle_sets(texts_of(wanted.select("doc_id").distinct(), docs), p).dropDuplicates(["print"])
    sets = tables.put(sets.join(wanted.drop("doc_id"), "print").drop("print"))
    tables.drop(nodes)
    spokes = live.where("node != center").select(*ordered("node", "center")).distinct()
    edges = tables.put(linked(spokes, sets, p))
    left = torn(live, edges, tables)
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("k"))
    hub = left.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("k", "node", "root")).alias("hub"))
    size = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("w"))
    hub = tables.put(hub.join(size, "bucket"))
    spokes = spread_join(left, hub, ["bucket"], "w", left.count()).where(F.col("root") != F.col("hub.root"))
    spokes = spokes.select("node", F.col("hub.node").alias("center"))
    edges = tables.put(edges.unionByName(linked(spokes.select(*ordered("node", "center")).distinct(), sets, p)))
    tables.drop(left, hub)
    left = torn(live, edges, tables)
    tables.drop(live)
    open_ = tables.put(left.select("node", "root").distinct())
    tables.drop(left)
    pairs = tables.put(across(open_.join(sets.select("node", "shingles", "odd"), "node"), p, tables))
    # each set with the partner that its sketch likes best, then what is still apart
    best = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"), "est")
    best = best.groupBy("node").agg(F.max(F.struct("est", "a", "b")).alias("e")).select("e.a", "e.b").distinct()
    edges = tables.put(edges.unionByName(linked(best, sets, p)))
    root = stars(edges, tables)
    for k in "ab":
        pairs = pairs.join(root.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}")), k, "left")
    pairs = pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    return stars(edges.unionByName(linked(pairs, sets, p)), tables)


def torn(live: DataFrame, edges: DataFrame, tables: Tables) -> DataFrame:
    """(bucket, node, root) of the buckets that hold more than one component."""
    now = live.select("bucket", "node").join(stars(edges, tables), "node", "left").withColumn("root", F.coalesce("root", "node"))
    now = tables.put(now)
    parts = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("k"))
    out = tables.put(spread_join(now, parts, ["bucket"], "k", now.count()).where("lo != hi").select("bucket", "node", "root"))
    tables.drop(now)
    return out


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of the given doc_ids, which are broadcast only when few."""
    ids = cut(ids.select(F.col("doc_id").alias("_id")))
    ids = F.broadcast(ids) if ids.count() <= ID_BROADCAST_ROWS else ids
    src = columns(docs, doc_id="long", text="string")
    return src.join(ids, src["doc_id"].eqNullSafe(ids["_id"]), "left_semi").select("text")


def placed(docs: DataFrame, p: Near) -> DataFrame:
    """doc_id, text_hash, n, root (null without shingles), component_id, kept of every row."""
    tables = Tables(docs.sparkSession, "near")
    sig = tables.put(signatures(docs, p))
    classes = sig.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("d"), F.max("n").alias("n"),
        F.first("bands").alias("bands"), F.first("odd").alias("odd"), F.count(F.lit(1)).alias("rows"))
    classes = tables.put(classes.select(
        F.monotonically_increasing_id().alias("node"), F.col("node").alias("print"), F.col("d.doc_id").alias("doc_id"), "n", "bands", "odd", "rows"))
    slim = tables.put(sig.select("doc_id", "text_hash", "n", "node"))
    tables.drop(sig)
    root = components(classes, docs, p, tables)
    part = classes.select("node", "print", "doc_id", "rows")
    part = part.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = part.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("k"))
    part = spread_join(part, smallest, ["root"], "k", classes.count()).select(F.col("print").alias("node"), "root", "component_id", "rows")
    some = F.col("node").isNotNull()
    none = slim.where(~some).withColumns({"root": F.lit(None).cast("long"), "component_id": F.lit(None).cast("long")})
    out = spread_join(slim.where(some), tables.put(part), ["node"], "rows", slim.count()).drop("rows").unionByName(none)
    cid = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n", "root", cid.alias("component_id"), F.col("doc_id").eqNullSafe(cid).alias("kept"))


def near_duplicates(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return placed(docs, p).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def keep_one(docs: DataFrame, p: Near = Near()) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest doc_id; among
    several of this doc_id any one of the text with the least hash.  Rows without
    shingles and components of only null ids stay whole."""
    rows = cut(placed(docs, p).groupBy("doc_id", "text_hash", "root", "component_id", "kept").agg(F.count(F.lit(1)).alias("k")))
    able = rows.where("kept and root is not null and component_id is not null")
    first = able.groupBy("root").agg(F.min("text_hash").alias("least"))
    able = able.join(first, "root")
    key = ("doc_id", "text_hash")
    gone = rows.where(~F.col("kept")).select(*key).unionByName(able.where("text_hash != least").select(*key))
    out = with_decision(docs, gone)
    again = cut(able.where("text_hash = least and k > 1").select(*key))
    if again.isEmpty():
        return out
    copies = with_decision(out, again, "left_semi").withColumns({"_text_hash": IDENTITY["text_hash"](out)})
    return with_decision(out, again).unionByName(copies.dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash"))


def op10_odd_sketch_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of documents linked by word 3-shingles at 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Near(shingle=3, percent=85))
