"""Conversation prefix trie with subtree totals by time-forward processing.

Every conversation is a sequence of turns; each distinct sequence of first d turns
is a node.  A node is told by the exclusive or of the hashes (128 bits) of its
turns with their places, so prefixes come from running sums over rows that are
range-partitioned by (conversation, turn): a conversation that spans partitions,
however long, gets its sums from each partition's edges (two rows each).

A node's owner is its smallest conversation.  The nodes of one owner with the same
number of members follow each other without a branch, so the trie is folded to
chains, at most two to a conversation.  Totals over the chains below are passed
upwards: chains are sorted by reverse level order within shards (ranges of
owners), and each sends what its subtree holds to the node above it through a
priority queue that the shard reads along with its rows.  What is addressed to
another shard, or does not fit a queue of ``queue`` messages, is written out, summed by
its address and read by the next round; the rounds end when nothing is written.
All totals are sums, so a late message only adds.  Leaves send theirs by one
grouped sum before that, so a node with very many leaf children is no hot key.

Members that end at a node are hashed in order: ids are joined to pieces within
range partitions, and one pass over the pieces of a node makes the digest.

Defined results.  Turns are ordered by turn (null first), role and a hash of the
text; null role or text is empty; rows that repeat all are turns of their own.
Rows without conv_id belong to no conversation.  An empty table has no node.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triad.llm.common import columns, cut, documents, spread_join

QUEUE = 200_000                  # messages a shard holds at a time
SHARD_ROWS = 100_000             # chains of a shard, as long as there are few shards
PIECE = 4_096                    # ids joined to one piece
NODE = ["depth", "p1", "p2"]


def batch_of(**arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays.values()], names=list(arrays))


# ---------------------------------------------------------------------------
# running sums over sorted rows
# ---------------------------------------------------------------------------

def running(rows: DataFrame, add: list[str], xor: list[str]) -> DataFrame:
    """``rows`` (checkpointed, sorted by conv_id within range partitions, with ``part``) whose
    columns ``add`` and ``xor`` hold the running values within each conversation."""
    names = [*add, *xor]

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Totals of the first and the last conversation of the partition."""
        edge: list[list[int]] = []
        for b in batches:
            conv = b.column("conv_id").to_numpy()
            if not len(conv):
                continue
            part = int(b.column("part")[0].as_py())
            start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            sums = [(np.add if c in add else np.bitwise_xor).reduceat(b.column(c).to_numpy(), start) for c in names]
            for i in sorted({0, len(start) - 1}):
                row = [int(conv[start[i]]), part, *(int(s[i]) for s in sums)]
                if edge and edge[-1][0] == row[0]:
                    edge[-1][2:] = [x + y if c in add else x ^ y for c, x, y in zip(names, edge[-1][2:], row[2:], strict=True)]
                elif len(edge) < 2:
                    edge.append(row)
                else:
                    edge[-1] = row
        if edge:
            yield batch_of(**{c: np.array([e[i] for e in edge], dtype=np.int64) for i, c in enumerate(["conv_id", "part", *names])})

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, dict.fromkeys(names, 0)
        for b in batches:
            conv = b.column("conv_id").to_numpy()
            if not len(conv):
                continue
            new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
            first = np.cumsum(new) == 0                     # goes on from the batch before
            for c in names:
                v = b.column(c).to_numpy()
                if c in add:
                    s = np.cumsum(v)
                    s = s - np.where(first, -carry[c], (s - v)[start])
                else:
                    s = np.bitwise_xor.accumulate(v)
                    s = s ^ np.where(first, carry[c], (s ^ v)[start])
                carry[c] = int(s[-1])
                b = b.set_column(b.schema.get_field_index(c), c, pa.array(s))
            last = conv[-1]
            yield b

    edges = rows.select("conv_id", "part", *names).mapInArrow(totals, "conv_id long, part long, " + ", ".join(f"{c} long" for c in names))
    a, b = edges.alias("a"), edges.alias("b")
    later = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.part") < F.col("b.part")))
    later = later.groupBy(F.col("b.conv_id").alias("_c"), F.col("b.part").alias("_p")).agg(
        *[(F.sum if c in add else F.bit_xor)(f"a.{c}").alias(f"before_{c}") for c in names])
    out = rows.mapInArrow(local, rows.schema)
    # at most two rows to a partition
    out = out.join(F.broadcast(later), (F.col("conv_id") == F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    fixed = {c: F.coalesce(F.col(c) + F.col(f"before_{c}"), F.col(c)) if c in add else
             F.coalesce(F.col(c).bitwiseXOR(F.col(f"before_{c}")), F.col(c)) for c in names}
    return out.select(*[fixed[c].alias(c) if c in fixed else c for c in rows.columns if c != "part"])


def dealt(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` sorted over range partitions, written, with the partition's number."""
    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long")))


# ---------------------------------------------------------------------------
# turns, conversations, nodes
# ---------------------------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t1, t2 (hashes of role and text) and bytes of every turn."""
    d = columns(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
    d = d.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "text", "role").alias("t2"),
                 F.octet_length("text").cast("long").alias("bytes"), F.lit(1).cast("long").alias("pos"))
    d = dealt(d, ["conv_id", F.col("turn").asc_nulls_first(), "role", "t1", "t2"])
    return running(d.drop("turn", "role"), ["pos"], [])


def regrown(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the head of another one, and their turns.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on
    with its own turns after its first h, where h is its checksum modulo 9.
    Returns conv_id, size, and conv_id, depth, t1, t2, bytes, size.
    """
    turns = cut(turns)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("long")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = cut(convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(heads, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = cut(convs.select("conv_id", "base", "h", "k", "n", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")))
    head = turns.where("pos <= 8").withColumnRenamed("conv_id", "base")
    head = convs.select("conv_id", "base", "h", "size").join(head, "base").where("pos <= h").select(
        "conv_id", F.col("pos").alias("depth"), "t1", "t2", "bytes", "size")
    own = spread_join(turns, convs.select("conv_id", "h", "k", "n", "size"), ["conv_id"], "n", turns.count())
    own = own.where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "t1", "t2", "bytes", "size")
    return convs.select("conv_id", "size"), head.unionByName(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, p1, p2 (this prefix), q1, q2 (the one before), bytes, cum (bytes up to here), size."""
    rows = rows.withColumn("c1", F.xxhash64("depth", "t1", "t2")).withColumn("c2", F.xxhash64("t2", "t1", "depth"))
    rows = rows.select("conv_id", "depth", "bytes", "size", "c1", "c2", F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("bytes").alias("cum"))
    rows = running(dealt(rows, ["conv_id", "depth"]), ["cum"], ["p1", "p2"])
    return rows.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("c1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("c2")).alias("q2"),
                       "bytes", "cum", "size")


def nodes_of(convs: DataFrame, rows: DataFrame, many: int) -> DataFrame:
    """One row per node: its key and parent's, conv_id and parent_conv_id, n_convs, n_ends, bytes, cum."""
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                     F.coalesce(F.sum((F.col("size") == 0).cast("long")), zero).alias("n_ends")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in (*NODE, "q1", "q2", "bytes", "cum")], "conv_id", "n_convs", "n_ends")
    g = rows.groupBy(*NODE).agg(*[F.max(c).alias(c) for c in ("q1", "q2", "bytes", "cum")], F.min("conv_id").alias("conv_id"),
                                F.count(F.lit(1)).alias("n_convs"), F.sum((F.col("depth") == F.col("size")).cast("long")).alias("n_ends"))
    nodes = cut(root.unionByName(g))
    above = nodes.where("n_convs > n_ends").select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                                                   F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("above_convs"))
    # a node has no more children than members
    low = spread_join(nodes.where("depth > 0"), above, ["depth", "q1", "q2"], "above_convs", many)
    return cut(low.drop("above_convs").unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))))


# ---------------------------------------------------------------------------
# time-forward processing
# ---------------------------------------------------------------------------

class Queue:
    """Messages (-depth, conv_id, children, leaves, saved) in reverse level order.  Of more than ``most``
    the later half leaves as ``spilled``, for the next round."""

    def __init__(self, most: int):
        self.most, self.heap, self.spilled = most, [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self.heap.sort()
            half = len(self.heap) // 2
            self.spilled += self.heap[half:]
            del self.heap[half:]

    def before(self, key: tuple, out: list) -> None:
        """Messages to nodes before ``key`` found no node here."""
        while self.heap and self.heap[0][:2] < key:
            out.append(heapq.heappop(self.heap))

    def take(self, key: tuple, total: list) -> bool:
        found = False
        while self.heap and self.heap[0][:2] == key:
            total[:] = [a + b for a, b in zip(total, heapq.heappop(self.heap)[2:], strict=True)]
            found = True
        return found


PASS = "sent boolean, depth long, conv_id long, children long, leaves long, saved long"


def shard_pass(first: bool, most: int):
    """Streams a shard's rows (messages before the chain they are for) in reverse level order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard, out, outside = Queue(most), None, [], []
        key, total, told = None, [0, 0, 0], False

        def drawn(done: bool) -> Iterator[pa.RecordBatch]:
            nonlocal out, outside
            rows = [(False, *r) for r in out] + [(True, -m[0], *m[1:]) for m in outside + queue.spilled]
            if rows and (done or len(rows) > 50_000):
                out, outside, queue.spilled = [], [], []
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.bool_()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                                 names=[x.split()[0] for x in PASS.split(", ")])

        for b in batches:
            for s, depth, conv, kind, up_conv, up_depth, gain, children, leaves, saved in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    queue.before((1 << 62, 0), outside)
                    shard = s
                if (-depth, conv) != key:
                    key, total, told = (-depth, conv), [0, 0, 0], False
                if kind == 0:
                    total, told = [total[0] + children, total[1] + leaves, total[2] + saved], True
                    continue
                queue.before(key, outside)
                told = queue.take(key, total) or told
                if told:
                    out.append((depth, conv, *total))
                if up_conv is not None and (first or told):
                    queue.push((-up_depth, up_conv, 1 if first else 0, total[1], total[2] + (gain if first else 0)))
            yield from drawn(False)
        queue.before((1 << 62, 0), outside)
        yield from drawn(True)

    return run


def subtree_totals(inner: DataFrame, messages: DataFrame, shard_rows: int, queue: int) -> DataFrame:
    """conv_id, depth, children, leaves, saved of everything below each of the chains ``inner``
    (conv_id, depth of the last node, up_conv, up_depth, gain), given ``messages`` to them."""
    spark = inner.sparkSession
    inner, messages = cut(inner), cut(messages)
    shards = max(1, min(-(-inner.count() // shard_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = np.array(sorted(set(inner.approxQuantile("conv_id", [i / shards for i in range(1, shards)], 0.1 / shards)))) if shards > 1 else np.empty(0)

    def located(df: DataFrame) -> DataFrame:
        def place(batches):
            for b in batches:
                s = np.searchsorted(bounds, b.column("conv_id").to_numpy(zero_copy_only=False), side="right")
                yield b.append_column("shard", pa.array(s.astype(np.int64)))
        return df.mapInArrow(place, T.StructType([*df.schema.fields, T.StructField("shard", T.LongType())]))

    none = F.lit(None).cast("long")
    chains = cut(located(inner))
    chains = chains.select("shard", "depth", "conv_id", F.lit(1).alias("kind"), "up_conv", "up_depth", "gain", *[none.alias(c) for c in ("children", "leaves", "saved")])
    done, first = [], True
    while True:
        sent = located(messages.select("conv_id", "depth", "children", "leaves", "saved"))
        sent = sent.select("shard", "depth", "conv_id", F.lit(0).alias("kind"), *[none.alias(c) for c in ("up_conv", "up_depth", "gain")], "children", "leaves", "saved")
        rows = chains.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", F.col("depth").desc(), "conv_id", "kind")
        out = cut(rows.mapInArrow(shard_pass(first, queue), PASS))
        done.append(out.where("NOT sent"))
        messages = out.where("sent").groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        first = False
        if messages.isEmpty():
            return reduce(DataFrame.unionByName, done).groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])


def chains_of(nodes: DataFrame) -> DataFrame:
    """Nodes of one owner and one number of members, folded: first and last depth, what is above, bytes."""
    c = nodes.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.max("depth").alias("depth"), F.min_by("parent_conv_id", "depth").alias("up_conv"),
        F.sum("bytes").alias("bytes"), F.max("cum").alias("end_cum"), F.max("n_ends").alias("n_ends"))
    # only the last node of a chain can have ends
    return c.select("*", (F.col("top") - 1).alias("up_depth"), (F.col("n_convs") == F.col("n_ends")).alias("leaf"),
                    ((F.col("n_convs") - 1) * F.col("bytes")).alias("gain"))


# ---------------------------------------------------------------------------
# members that end at a node
# ---------------------------------------------------------------------------

def end_digests(ends: DataFrame) -> DataFrame:
    """NODE and ends_sha256 from (NODE, conv_id)."""
    key = [*NODE, "conv_id"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy() for c in NODE])
            new = np.r_[True, (k[:, 1:] != k[:, :-1]).any(axis=0)]
            run = np.arange(b.num_rows) - np.maximum.accumulate(np.where(new, np.arange(b.num_rows), 0))
            start = np.flatnonzero(new | (run % PIECE == 0))
            ids = b.column("conv_id").to_pylist()
            text = [",".join(map(str, ids[i:j])) for i, j in zip(start, np.r_[start[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(start)) for c in key] + [pa.array(text)], names=[*key, "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for b in batches:
            out = []
            for *k, _, piece in zip(*(b.column(c).to_pylist() for c in [*key, "piece"]), strict=True):
                if k == node:
                    h.update(b",")
                else:
                    if node:
                        out.append((*node, h.hexdigest()))
                    node, h = k, hashlib.sha256()
                h.update(piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*NODE, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, h.hexdigest())], names=[*NODE, "ends_sha256"])

    typed = "depth long, p1 long, p2 long"
    p = ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(pieces, f"{typed}, conv_id long, piece string")
    return p.repartition(*NODE).sortWithinPartitions(*key).mapInArrow(digests, f"{typed}, ends_sha256 string")


def prefix_trie(convs: DataFrame, rows: DataFrame, shard_rows: int = SHARD_ROWS, queue: int = QUEUE) -> DataFrame:
    """The trie of conversations ``convs`` (conv_id, size) with turns ``rows`` (conv_id, depth, t1, t2, bytes, size).
    One row per node: conv_id, depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rows = cut(convs), cut(prefixes(rows))
    many = rows.count() + convs.count()
    nodes = nodes_of(convs, rows, many)
    chains = cut(chains_of(nodes))
    leaf = chains.where("leaf AND up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.count(F.lit(1)).alias("children"), F.count(F.lit(1)).alias("leaves"), F.sum("gain").alias("saved"))
    inner = chains.where("NOT leaf AND n_convs > 1").select("conv_id", "depth", "up_conv", "up_depth", "gain")
    below = subtree_totals(inner, leaf, shard_rows, queue)
    chains = chains.where("n_convs > 1").join(below, ["conv_id", "depth"], "left")
    chains = cut(chains.select("conv_id", "n_convs", F.col("depth").alias("bottom"), "end_cum", (F.col("depth") - F.col("top") + 1).alias("length"),
                               F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("leaves", F.lit(1)).alias("leaves"),
                               F.coalesce("saved", F.lit(0)).alias("below")))
    ends = rows.where("depth = size").select(*NODE, "conv_id").unionByName(
        convs.where("size = 0").select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id"))
    nodes = nodes.join(end_digests(ends), NODE, "left").drop("p1", "p2", "q1", "q2")
    shared = spread_join(nodes.where("n_convs > 1"), chains, ["conv_id", "n_convs"], "length", many)
    key = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_ends"]
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    saved = F.col("below") + (F.col("n_convs") - 1) * (F.col("end_cum") - F.col("cum") + F.col("bytes"))
    shared = shared.select(*key, F.when(F.col("depth") == F.col("bottom"), F.col("children")).otherwise(1).alias("n_children"),
                           F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), digest)
    # one conversation alone: a path without a branch
    alone = nodes.where("n_convs = 1").select(*key, (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                                              F.lit(0).cast("long").alias("saved_tokens"), digest)
    return shared.unionByName(alone)


def trie(conversations: DataFrame, **limits) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = cut(turns_of(conversations))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    rows = spread_join(turns.withColumnRenamed("pos", "depth"), sizes.withColumn("n", F.col("size")), ["conv_id"], "n", turns.count()).drop("n")
    return prefix_trie(sizes, rows, **limits)


# Fixed value: the polynomial of CRC-32.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(c::VARCHAR, ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

#: Each node's subtree is the nodes whose owner's path goes through it.
OP11_SQL = f"""WITH t AS (SELECT conv_id c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) pos,
  coalesce(role, '') AS role, coalesce(text, '') AS tx FROM conversations WHERE conv_id IS NOT NULL),
v AS MATERIALIZED (SELECT c, count(*) n, c - c % 5 b, {_CRC} % 9 h FROM t GROUP BY c),
w AS (SELECT v.c, v.b, v.h, least(v.h, coalesce(z.n, 0)) k FROM v LEFT JOIN v z ON z.c = v.b),
r AS (SELECT w.c, pos d, role, tx FROM w JOIN t ON t.c = w.b AND pos <= h UNION ALL SELECT w.c, pos - h + k, role, tx FROM w JOIN t ON t.c = w.c AND pos > h),
m AS MATERIALIZED (SELECT c, d, strlen(tx) bytes, sha256(string_agg(length(role) || ':' || role || length(tx) || ':' || tx, '') OVER (PARTITION BY c ORDER BY d)) p,
  max(d) OVER (PARTITION BY c) size FROM r
  UNION ALL SELECT c, 0, 0, sha256(''), coalesce((SELECT max(d) FROM r WHERE r.c = w.c), 0) FROM w),
n AS MATERIALIZED (SELECT d, p, min(c) conv_id, count(*) k, max(bytes) bytes, count(*) FILTER (d = size) e,
  coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size), '') ends FROM m GROUP BY d, p),
o AS MATERIALIZED (SELECT m.c, m.d, n.conv_id FROM m JOIN n USING (d, p)),
a AS (SELECT o.conv_id, o.d, sum((u.k - 1) * u.bytes)::BIGINT saved, count(*) FILTER (u.k = u.e) leaves, count(*) FILTER (u.d = o.d + 1) children
  FROM n u JOIN o ON o.c = u.conv_id AND o.d <= u.d GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, o.conv_id AS parent_conv_id, n.k AS n_convs, n.e AS n_ends, children AS n_children, leaves AS n_leaves,
  saved AS saved_tokens, sha256(ends) AS ends_sha256
FROM n JOIN a ON a.conv_id = n.conv_id AND a.d = n.d LEFT JOIN o ON o.c = n.conv_id AND o.d = n.d - 1"""


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie(*regrown(turns_of(documents(spark, sf_dir, "conversations"))))
