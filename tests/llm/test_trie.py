"""The prefix trie: SQL on the test tables, brute force on made-up ones, many small shards."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import compare, duck
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from triad.llm import trie as T

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    convs = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - int(np.fmod(c, 5)), [])[:h[c]] + own[h[c]:] for c, own in convs.items()}
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    total = {}
    for n in sorted(members, key=len, reverse=True):
        kids = [k for k in total if len(k) == len(n) + 1 and k[:-1] == n] if len(members) < 500 else None
        total[n] = kids
    out = []
    children = {n: 0 for n in members}
    leaves, saved = dict.fromkeys(members, 0), {}
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        saved[n] = saved.get(n, 0) + own
        leaves[n] = leaves[n] or 1
        if n:
            children[n[:-1]] += 1
            leaves[n[:-1]] += leaves[n]
            saved[n[:-1]] = saved.get(n[:-1], 0) + saved[n]
    for n, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(n))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(ends), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def result(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=lambda r: r[:2])


def invented(seed, n=160, deep=30):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-5, 3 * n), n):
        kind = rng.random()
        length = rng.randint(1, deep) if kind < .5 else rng.randint(1, 4)
        same = rng.randint(0, length) if kind < .8 else length
        for t in range(length):
            text = f"common {t}" if t < same else f"é{rng.randint(0, 2)}" * rng.randint(0, 3)
            rows.append((c, None if t == 0 and rng.random() < .2 else t, "user" if t % 2 else None, text or None))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rows = invented(seed)
    assert result(T.prefix_trie(*T.regrown(T.turns_of(frame(spark, rows))))) == brute(rows)


def test_many_shards_and_short_queues(spark):
    rows = invented(7, n=120, deep=60)
    want = brute(rows, rebuild=False)
    for limits in ({"shard_rows": 10, "queue": 3}, {"shard_rows": 7, "queue": 1000}, {}):
        assert result(T.trie(frame(spark, rows), **limits)) == want, limits


def test_query_against_sql(spark):
    for sf in (SF_SMALL, SF_MID):
        r = compare(spark, duck(sf), "op11", T.op11_prefix_trie, T.OP11_SQL, sf)
        assert r["hash_match"] and r["spark_rows"] > 20, r


def test_conversations_over_many_partitions(spark):
    rows = [(c, t, "user", f"x{t}") for c in (1, 2) for t in range(3000)] + [(3, t, "user", f"x{t}") for t in range(2500)]
    df = frame(spark, rows)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert result(T.trie(df)) == brute(rows, rebuild=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)


def test_edges(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, "user", "a"), (None, 0, "user", "a"), (7, 5, "x", "y" * 100_000)]
    df = frame(spark, rows).withColumn("depth", F.lit("?")).withColumn("p1", F.lit("?")).withColumn("size", F.lit("?"))
    assert result(T.trie(df)) == brute(rows, rebuild=False)
    assert T.trie(df.limit(0)).collect() == []
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    assert result(T.op11_prefix_trie(spark, str(tmp_path))) == brute(rows)


def test_queue_keeps_order_and_loses_nothing():
    q, rng = T.Queue(5), random.Random(3)
    sent = [(-rng.randint(0, 9), rng.randint(0, 9), 1, 1, 1) for _ in range(200)]
    for m in sent:
        q.push(m)
    out: list = []
    q.before((1, 0), out)
    assert out == sorted(out) and sorted(out + q.spilled) == sorted(sent)
