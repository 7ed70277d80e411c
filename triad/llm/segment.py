"""SentencePiece segmentations sampled without replacement by Gumbel top-k.

A text's lattice has a node for each character border and an edge for each piece
between two of them.  No piece crosses the start of a run of blanks or a line
break, so the lattice is a chain of small ones (chunks); each distinct chunk of a
batch gets its edges and its backward sums once, by array operations.  Backward
sums turn an edge's weight into the log-probability of taking it from its node.

The tree of partial segmentations is searched best first on perturbed scores: the
root draws a Gumbel value; a node's children draw theirs conditioned on the
largest being the node's own; so the best leaf below a node is worth what the
node is, and following the best child, then the best remaining sibling and so on
(A-star with an exact bound) emits distinct segmentations in the order of their
perturbed scores: a sample without replacement.  With kappa the next perturbed
score, segmentation s has been included with probability
1 - exp(-exp(log p(s) - kappa)), returned as ``log_inclusion``.

Draws are hashes of (seed, row key, path, chunk, place, edge), so a row's samples
do not depend on partitions or retries.  Paths of all texts of a batch advance
together, a piece at a time.

Weights: a unigram model's scores are log-probabilities; a BPE model's scores are
merge ranks, for which Zipf's law gives -log(rank + 2.7).  ``alpha`` multiplies
them.  A character without a piece of its own has one edge of its byte pieces.

Defined results: null gives no samples; empty text its one empty segmentation
with probability 1.  A text with fewer segmentations than k gives them all.  A
literal U+2581 is read as a blank, as the model's own encoder does.  Equal rows
have equal samples.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triad.llm.common import columns, mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
BASE = np.uint64(0x100000001B3)
PART = 50_000                    # chunks whose paths advance together
SLICE = 1 << 19                  # bytes of text that share a lattice: some 100 MB of arrays
U = np.uint64


@dataclass(frozen=True)
class Sampling:
    model: str = MODEL
    k: int = 2
    alpha: float = 1.0
    seed: int = 17
    ranked: bool = True          # scores are merge ranks (BPE), not log-probabilities


class Pieces:
    """A model's pieces as arrays; loaded on the driver, sent to the tasks."""

    def __init__(self, p: Sampling):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=p.model)
        self.texts: list[bytes] = []
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        normal = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            else:
                self.texts.append(b"" if sp.is_control(i) or sp.is_unknown(i) else piece.replace(BLANK, " ").encode())
                if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                    normal.append((i, piece, sp.get_score(i)))
        self.by_id = np.array(self.texts, dtype=object)
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        if any(BLANK in x.lstrip(BLANK) or ("\n" in x and len(x) > 1) for _, x, _ in normal):
            raise ValueError("a piece crosses the start of blanks or a line break")
        self.weight = np.zeros(len(self.texts) + 1)
        for i, _, s in normal:
            self.weight[i] = p.alpha * (-np.log(max(0.0, -s) + 2.7) if p.ranked else s)
        self.weight[-1] = self.weight.min() - 10.0 * p.alpha  # of bytes; index -1
        found: dict[int, int] = {}
        self.longest = max(len(x) for _, x, _ in normal)
        for i, piece, _ in normal:
            h = 0
            for c in piece:
                h = (h * int(BASE) + ord(c) + 1) % 2**64
                found.setdefault(h, -1)
            found[h] = i
        keys = np.array(list(found), dtype=np.uint64)
        self.bits = 18
        spot = (mix(keys) >> U(64 - self.bits)).astype(np.int64)
        order = np.argsort(spot, kind="stable")
        self.keys, self.values = keys[order], np.array(list(found.values()), dtype=np.int32)[order]
        self.first = np.searchsorted(spot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.fullest = int(np.diff(self.first).max())
        self.single = self.lookup(np.arange(1 << 14, dtype=np.uint64) + U(1))

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece id, -1 for what only begins a piece, -2 for anything else."""
        spot = (mix(h) >> U(64 - self.bits)).astype(np.int64)
        at, end = self.first[spot], self.first[spot + 1]
        out = np.full(len(h), -2, dtype=np.int32)
        left = np.arange(len(h))
        for _ in range(self.fullest):
            more = at[left] < end[left]
            left = left[more]
            if not len(left):
                break
            hit = self.keys[at[left]] == h[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit]
            at[left] += 1
        return out

    def first_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and :meth:`lookup` of single characters, by a table of the common ones."""
        h = code + U(1)
        low = code < len(self.single)
        if low.all():
            return h, self.single[code.astype(np.int64)]
        found = np.empty(len(code), dtype=np.int32)
        found[low], found[~low] = self.single[code[low].astype(np.int64)], self.lookup(h[~low])
        return h, found

    def decode(self, ids) -> str:
        """The text of a list or array of piece ids."""
        text = b"".join(self.by_id[ids].tolist()).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class Lattice:
    """Edges of distinct chunks, with their conditional log-probabilities."""

    def __init__(self, chunks: list[str], pieces: Pieces):
        size = np.fromiter(map(len, chunks), dtype=np.int32, count=len(chunks)) + np.int32(1)
        self.begin = np.cumsum(size, dtype=np.int32) - size
        self.code = np.frombuffer("\0".join([*chunks, ""]).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        last = self.begin + size - np.int32(1)
        self.code = np.where(self.code == 32, U(ord(BLANK)), self.code)
        n = len(self.code)
        stop = np.repeat(last, size)
        self.place = np.arange(n, dtype=np.uint32) - np.repeat(self.begin, size).astype(np.uint32)
        self.last = np.zeros(n, dtype=bool)
        self.last[last] = True
        every = at = np.flatnonzero(~self.last).astype(np.int32)
        h = np.zeros(len(at), dtype=np.uint64)
        self.count = np.zeros(n, dtype=np.int32)
        single = np.zeros(n, dtype=bool)
        starts, ends, ids, nths = [], [], [], []
        for length in range(1, pieces.longest + 1):
            # no piece holds the separator, so a prefix never leaves its chunk
            if length == 1:
                h, found = pieces.first_of(self.code[at])
            else:
                h *= BASE
                h += self.code[at + np.int32(length - 1)]
                h += U(1)
                found = pieces.lookup(h)
            keep = np.flatnonzero(found > -2)
            if not len(keep):
                break
            at, h, found = at[keep], h[keep], found[keep]
            whole = np.flatnonzero(found >= 0)
            start = at[whole]
            starts.append(start)
            ends.append(start + np.int32(length))
            ids.append(found[whole])
            nths.append(self.count[start])
            self.count[start] += 1
            if length == 1:
                single[start] = True
        bare = every[~single[every]]
        starts.append(bare)
        ends.append(bare + np.int32(1))
        ids.append(np.full(len(bare), -1, dtype=np.int32))
        nths.append(self.count[bare])
        self.count[bare] += 1
        # edges by node, nodes by their distance to the chunk's end
        left = stop[every] - every
        order = np.argsort(left, kind="stable")
        nodes, left = every[order], left[order]
        many = self.count[nodes]
        begin = np.cumsum(many, dtype=np.int32) - many
        self.first = np.zeros(n, dtype=np.int32)
        self.first[nodes] = begin
        start, nth = np.concatenate(starts), np.concatenate(nths)
        spot = self.first[start] + nth
        self.start, self.end, self.piece, self.nth = (np.empty(len(spot), dtype=t) for t in (np.int32, np.int32, np.int32, np.uint32))
        self.nth[spot] = nth.astype(np.uint32) * np.uint32(0x27D4EB2F)
        self.start[spot] = start
        del start, nth, starts, nths
        self.end[spot], self.piece[spot] = np.concatenate(ends), np.concatenate(ids)
        del ends, ids
        weight = pieces.weight[self.piece]
        beta = np.zeros(n)
        groups = np.flatnonzero(np.diff(left, prepend=-1))
        for a, b in zip(groups, [*groups[1:], len(nodes)], strict=False):
            e0, e1 = begin[a], begin[b] if b < len(nodes) else len(spot)
            x = weight[e0:e1] + beta[self.end[e0:e1]]
            seg = begin[a:b] - e0
            top = np.maximum.reduceat(x, seg)
            beta[nodes[a:b]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, many[a:b])), seg))
        self.logp = weight + beta[self.end] - beta[self.start]
        self.logp32 = self.logp.astype(np.float32)


def gumbel(bits: np.ndarray) -> np.ndarray:
    """Gumbel draws from 32-bit hashes."""
    x = bits ^ (bits >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    x >>= np.uint32(8)
    u = x.astype(np.float32)
    u += np.float32(0.5)
    u *= np.float32(2.0**-24)
    np.log(u, out=u)
    np.negative(u, out=u)
    np.log(u, out=u)
    return np.negative(u, out=u)


def shortfall(g: np.ndarray, x: np.ndarray, top: np.ndarray) -> np.ndarray:
    """What ranks values x, the smallest first, given that their maximum, which they miss by -top, is g."""
    with np.errstate(divide="ignore"):
        return g - x + np.log1p(-np.exp(np.minimum(top, -1e-7)))


def conditioned(g: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The values themselves."""
    return g - np.maximum(v, 0.0) - np.log1p(np.exp(-np.abs(v)))


LOW, WORST = np.int64(0xFFFFFFFF), np.int64(-2**63)


def packed(x: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Numbers whose order is that of x, with the edge in the low half."""
    i = x.view(np.int32)
    return ((i ^ ((i >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) << 32) | e


def unpacked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x and edge."""
    i = (key >> 32).astype(np.int32)
    return (i ^ ((i >> 31) & np.int32(0x7FFFFFFF))).view(np.float32), key & LOW


class Walk:
    """One path for each text, from the given chunk states to the texts' ends, and
    the best sibling at each of its nodes."""

    def __init__(self, lat: Lattice, text: np.ndarray, occ: np.ndarray, node: np.ndarray, key: np.ndarray, root: np.ndarray, phi: np.ndarray):
        """State arrays by text and chunk; by text: key (32 bits), perturbed score and log-probability so far."""
        n = len(text)
        states = np.flatnonzero(~lat.last[node])
        steps = np.zeros(n, dtype=np.int64)
        paths, near = [], []
        now = node[states]
        salt = key[text] + occ.astype(np.uint32) * np.uint32(0x9E3779B1)
        while len(states):
            keys, seg, shift = self.draws(lat, now, salt[states])
            top, best = unpacked(np.maximum.reduceat(keys, seg))
            paths.append((states, best))
            keys[best - shift] = WORST
            high = np.maximum.reduceat(keys, seg)
            some = np.flatnonzero(high > WORST)
            near.append((states[some], now[some], high[some], top[some]))
            steps[states] += 1
            now = lat.end[best]
            go = np.flatnonzero(~lat.last[now])
            states, now = states[go], now[go]
        off = np.cumsum(steps) - steps
        total = int(steps.sum())
        self.edge = np.empty(total, dtype=np.int64)
        self.occ = np.repeat(occ, steps)
        self.text = np.repeat(text, steps)
        for i, (s, best) in enumerate(paths):
            self.edge[off[s] + i] = best
        step_p = lat.logp[self.edge]
        self.bounds = np.searchsorted(self.text, np.arange(len(key) + 1))
        self.phi, self.final = np.empty(total), phi.copy()  # before each piece; at the end
        for t in np.unique(self.text):  # text by text: sums must not depend on the batch
            a, b = self.bounds[t], self.bounds[t + 1]
            run = np.cumsum(step_p[a:b])
            self.phi[a:b] = phi[t] + run - step_p[a:b]
            self.final[t] = phi[t] + run[-1]
        self.lat, self.root, self.salt = lat, root, salt
        parts = [(np.full(len(s), i), s, node_, high, top) for i, (s, node_, high, top) in enumerate(near)]
        self.sib = [np.concatenate(c) if c else np.empty(0, t) for c, t in zip(
            zip(*parts, strict=True) if parts else [()] * 5, (np.int64, np.int64, np.int32, np.int64, np.float32), strict=True)]
        level, state = self.sib[0], self.sib[1]
        self.sib_at = off[state] + level

    @staticmethod
    def draws(lat: Lattice, now: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed perturbed scores of the edges of the nodes ``now``, where each node's begin, and
        by node the edge number less its place."""
        cnt, first = lat.count[now], lat.first[now]
        seg = np.cumsum(cnt, dtype=np.int32) - cnt
        shift = first - seg
        e = np.repeat(shift, cnt)
        e += np.arange(len(e), dtype=np.int32)
        h = salt ^ (lat.place[now] * np.uint32(0x85EBCA77))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
        x = gumbel(np.repeat(h, cnt) + lat.nth[e])
        x += lat.logp32[e]
        return packed(x, e), seg, shift

    def shortfalls(self, i) -> np.ndarray:
        """What ranks the siblings ``i``."""
        x, top = unpacked(self.sib[3][i])[0].astype(np.float64), self.sib[4][i].astype(np.float64)
        at = self.sib_at[i]
        return shortfall(self.root[self.text[at]], self.phi[at] + x, x - top)

    def best_siblings(self, n_texts: int, k: int) -> list[list[tuple]]:
        """By text, the k siblings of highest value as (value, place on the path, edge).  Where a text
        takes a node's best sibling, the next best one stands in for it."""
        out: list[list[tuple]] = [[] for _ in range(n_texts)]
        v = self.shortfalls(slice(None))
        owner = self.text[self.sib_at]
        for r in range(k):
            top = np.full(n_texts, np.inf)
            np.minimum.at(top, owner, v)
            hit = np.flatnonzero((v == top[owner]) & (v < np.inf))
            _, one = np.unique(owner[hit], return_index=True)
            hit = hit[one]
            g = conditioned(self.root[owner[hit]], v[hit])
            for i, x, edge in zip(hit.tolist(), g.tolist(), unpacked(self.sib[3][hit])[1].tolist(), strict=True):
                out[owner[i]].append((x, int(self.sib_at[i] - self.bounds[owner[i]]), edge))
            v[hit] = np.inf
            if r + 1 < k and len(hit):
                keys, seg, _ = self.draws(self.lat, self.sib[2][hit], self.salt[self.sib[1][hit]])
                taken = np.repeat(self.sib[3][hit], self.lat.count[self.sib[2][hit]])
                keys[keys >= taken] = WORST
                self.sib[3][hit] = nxt = np.maximum.reduceat(keys, seg)
                some = hit[nxt > WORST]
                v[some] = self.shortfalls(some)
        return out


CHUNK = re.compile(r" *[^ \n]+|\n| +")


def with_bytes(lat: Lattice, edges: np.ndarray, pieces: Pieces) -> np.ndarray:
    """The piece ids of a path; characters without a piece become their bytes."""
    ids = lat.piece[edges]
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids
    code = lat.code[lat.start[edges[bare]]]
    if (code < 0x80).all():
        ids[bare] = pieces.byte_ids[code.astype(np.int64)]
        return ids
    size = np.ones(len(ids), dtype=np.int64)
    size[bare] = 1 + (code >= 0x80) + (code >= 0x800).astype(np.int64) + (code >= 0x10000)
    at = (np.cumsum(size) - size)[bare]
    ids = np.repeat(ids, size)
    plain = code < 0x80
    ids[at[plain]] = pieces.byte_ids[code[plain].astype(np.int64)]
    for i, c in zip(at[~plain], code[~plain], strict=True):
        own = pieces.byte_ids[list(chr(int(c)).encode("utf-8", "surrogatepass"))]
        ids[i:i + len(own)] = own
    return ids


def sample(texts: list[str], keys: np.ndarray, pieces: Pieces, p: Sampling, part: int = PART) -> list[list[tuple]]:
    """For each text its samples (ids, log-probability, perturbed score, log-inclusion).  All texts
    share one lattice; the paths of about ``part`` chunks advance together."""
    number: defaultdict[str, int] = defaultdict(count().__next__)   # chunks by first place, one look-up each
    cuts = (CHUNK.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts)
    chunks = [np.fromiter(map(number.__getitem__, c), dtype=np.int32, count=len(c)) for c in cuts]
    lat = Lattice(list(number), pieces)
    del cuts, number
    ends = np.cumsum([len(c) for c in chunks], dtype=np.int64) // part
    starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(ends) else []
    out = []
    for i, j in zip(starts, [*starts[1:], len(texts)], strict=True):
        out += paths_of(chunks[i:j], keys[i:j], lat, pieces, p)
    return out


def paths_of(chunks: list[np.ndarray], keys: np.ndarray, lat: Lattice, pieces: Pieces, p: Sampling) -> list[list[tuple]]:
    """The samples of some texts, given as numbers of chunks of the lattice."""
    n = len(chunks)
    size = np.array([len(c) for c in chunks], dtype=np.int64)
    begin = np.cumsum(size) - size
    chunk = np.concatenate(chunks)
    root = gumbel((keys >> U(32)).astype(np.uint32)).astype(np.float64)
    prefix = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))] * n
    paths: list[list[tuple]] = [[] for _ in range(n)]   # (edges, occ, phi, final, g)
    pool: list[list[tuple]] = [[] for _ in range(n)]    # (value, path, place, edge)
    text, occ, node = np.repeat(np.arange(n), size), np.arange(len(chunk)) - np.repeat(begin, size), lat.begin[chunk]
    phi, alive = np.zeros(n), np.ones(n, dtype=bool)
    for r in range(p.k):
        low = (mix(keys + U(r + 1)) & U(0xFFFFFFFF)).astype(np.uint32)
        walk = Walk(lat, text, occ, node, low, root, phi)
        near = walk.best_siblings(n, p.k - r)
        for t in np.flatnonzero(alive):
            a, b = walk.bounds[t], walk.bounds[t + 1]
            e, o, f = prefix[t]
            paths[t].append((np.concatenate([e, walk.edge[a:b]]), np.concatenate([o, walk.occ[a:b]]),
                             np.concatenate([f, walk.phi[a:b]]), walk.final[t], root[t]))
            pool[t] = sorted(pool[t] + [(g, r, at + len(e), edge) for g, at, edge in near[t]], reverse=True)[:p.k - r]
        if r + 1 == p.k:
            break
        texts_on, occs_on, nodes_on = [], [], []
        root, phi, alive = np.zeros(n), np.zeros(n), np.zeros(n, dtype=bool)
        for t in range(n):
            if not pool[t] or len(paths[t]) <= r:
                continue
            g, path, at, edge = pool[t].pop(0)
            e, o, f, _, _ = paths[t][path]
            prefix[t] = (np.r_[e[:at], edge], o[:at + 1], f[:at + 1])
            alive[t], root[t], phi[t] = True, g, f[at] + lat.logp[edge]
            rest = np.arange(o[at], size[t])
            go = lat.begin[chunk[begin[t] + rest]]
            go[0] = lat.end[edge]
            texts_on.append(np.full(len(rest), t))
            occs_on.append(rest)
            nodes_on.append(go)
        text, occ, node = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (texts_on, occs_on, nodes_on))
    out = []
    for t in range(n):
        kappa = pool[t][0][0] if pool[t] and len(paths[t]) == p.k else -np.inf
        rows = []
        for e, _, _, final, g in paths[t]:
            ids = with_bytes(lat, e, pieces)
            # log(1 - exp(-exp(final - kappa)))
            d = final - kappa
            inclusion = 0.0 if d > 4 else float(np.log(-np.expm1(-np.exp(d))) if d > -30 else d)
            rows.append((ids, float(final), float(g), inclusion))
        out.append(rows)
    return out


SAMPLE = "array<struct<ids: array<int>, log_prob: double, perturbed: double, log_inclusion: double, round_trip: boolean>>"


def sampled(batches: Iterator[pa.RecordBatch], pieces: Pieces, p: Sampling) -> Iterator[pa.RecordBatch]:
    """doc_id and ``samples`` of batches of doc_id, text and row_key.  Memory is that of one
    slice's arrays, whatever the batch; a row longer than a slice is a slice of its own."""
    kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("perturbed", pa.float64()),
                               ("log_inclusion", pa.float64()), ("round_trip", pa.bool_())]))
    for b in slices(batches, "text", SLICE):
        texts = b.column("text").to_pylist()
        at = [i for i, t in enumerate(texts) if t is not None]
        keys = b.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[at]
        found: list = [None] * len(texts)
        for i, rows in zip(at, sample([texts[i] for i in at], mix(keys), pieces, p) if at else [], strict=True):
            plain = texts[i].replace(BLANK, " ")
            found[i] = [{"ids": ids, "log_prob": lp, "perturbed": g, "log_inclusion": inc, "round_trip": pieces.decode(ids) == plain}
                        for ids, lp, g, inc in rows]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "samples"])


def encode(docs: DataFrame, p: Sampling = Sampling()) -> DataFrame:
    """doc_id and ``samples`` of every row, best perturbed score first."""
    pieces = Pieces(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sampled(batches, pieces, p)

    src = columns(docs, doc_id="long", text="string").withColumn("row_key", F.xxhash64(F.lit(p.seed), "doc_id", F.xxhash64("text")))
    return src.mapInArrow(run, f"doc_id long, samples {SAMPLE}")


def decode(rows: DataFrame, ids: str = "ids", p: Sampling = Sampling()) -> DataFrame:
    """``rows`` with ``text`` decoded from a column of ids (null from null)."""
    pieces = Pieces(p)

    @F.pandas_udf("string")
    def text(x):
        return x.map(lambda v: None if v is None else pieces.decode(np.asarray(v, dtype=np.int64)))

    return rows.withColumn("text", text(F.col(ids)))


def encoded(docs: DataFrame, p: Sampling = Sampling()) -> DataFrame:
    """One row for each sample: doc_id, sample (from 1), ids and the scores."""
    rows = encode(docs, p).select("doc_id", F.posexplode("samples").alias("pos", "s"))
    return rows.select("doc_id", (F.col("pos") + 1).alias("sample"), "s.*")


def op7_gumbel_topk(spark, sf_dir: str) -> DataFrame:
    """Digest of every document's samples; ids_hash stands for the ids."""
    rows = encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "perturbed",
                       "log_inclusion", F.xxhash64("ids").alias("ids_hash"), "round_trip")
