"""Helpers shared by the training-data operators.

Every operator takes the columns it needs by name and casts them, so extra
columns, whatever their names, are never read; work columns are made only on
such projections and cannot clash with the caller's.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.session import ensure_checkpoint_dir, stage_dir

WHITE = b" \t\n\r\x0b\x0c"
#: Ids and decisions are broadcast up to so many rows (16 MB); counted first.
ID_BROADCAST_ROWS = 1_000_000
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; lineage ends there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Tables:
    """Intermediate tables of one run of an operator, as Parquet in a folder of its own under the
    shared one.  A table that nothing reads any more can go, so that rounds do not pile up."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.paths = spark, stage_dir(spark, f"scratch/{name}-{uuid.uuid4().hex}"), {}

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path, out
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[id(t)][0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns of ``df``, cast."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(lo), int(hi - lo))


def raw(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a fixed permutation that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


#: What a row is told by: itself, so that a repeated or null doc_id shares nothing.
IDENTITY = {"doc_id": lambda df: df["doc_id"].cast("long"), "lang": lambda df: df["lang"].cast("string"),
            "source": lambda df: df["source"].cast("string"), "text_hash": lambda df: F.xxhash64(df["text"].cast("string"))}


def with_decision(docs: DataFrame, decided: DataFrame, how: str = "left_anti") -> DataFrame:
    """``docs`` without (or only) the rows in ``decided``, whose columns are some of
    IDENTITY.  Nulls equal nulls.  Rows alike in all of them share their fate, so
    they must be all that the decision depends on."""
    names = decided.columns
    marks = cut(decided.select(*[F.col(c).alias(f"_decided_{c}") for c in names]).distinct())
    marks = F.broadcast(marks) if marks.count() <= ID_BROADCAST_ROWS else marks
    same = [IDENTITY[c](docs).eqNullSafe(marks[f"_decided_{c}"]) for c in names]
    return docs.join(marks, reduce(Column.__and__, same), how)


#: At most so many keys of :func:`spread_join` are told to every task.
HOT_KEYS = 100_000


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, rows: int) -> DataFrame:
    """``left`` left-joined to ``right``, which has one row for each key and, in ``weight``, how
    many of the ``rows`` rows of ``left`` have it.  Keys of more than rows / HOT_KEYS
    rows (at least 1,000) number fewer than HOT_KEYS, so they are broadcast; only
    the others are shuffled, and no task gets more than such a share of one key."""
    least = max(1_000, rows // HOT_KEYS)
    values = [c for c in right.columns if c not in keys]
    if rows <= least:            # no key can be hot
        return left.join(right, keys, "left").select(*left.columns, *values)
    hot = F.col(weight) > least
    told = right.where(hot).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in values])
    near = left.join(F.broadcast(told), keys, "left")
    known = F.col(f"_hot_{weight}").isNotNull()
    done = near.where(known).select(*left.columns, *[F.col(f"_hot_{c}").alias(c) for c in values])
    rest = near.where(~known).select(*left.columns).join(right.where(~hot), keys, "left").select(*left.columns, *values)
    return done.unionByName(rest)
