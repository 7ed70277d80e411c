"""Delimited text extracts (A1–A8) and the conform step shared by all sources.

Layout of an extract: one or more part files ``<TABLE>_<digits>.TXT`` per
table, first line a header, fields separated by ``#|#``, no quoting,
optionally GBK.  Header order may differ between parts, so parts are grouped
by header line and each group is read with its own all-string schema in file
order; columns are then selected by (trimmed, upper-cased) name.

Only the first line of every part is read on the driver (through the Hadoop
FileSystem API, so it works on any cluster file system); the rows themselves
are read by the executors.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EXTRACT_SEP, TABLE_FILE_GLOBS
from ..session import stage_dir
from .schema import column_default, column_type, table_columns

CORRUPT = "_corrupt"
_NAME_OK = re.compile(r"^[A-Z][A-Z0-9_]*$")


# --------------------------------------------------------------------------
# conform: canonical names, types and the file-order column
# --------------------------------------------------------------------------

def _typed(c: Column, src_type: T.DataType, col: str) -> Column:
    target = column_type(col)
    if isinstance(target, T.StringType):
        return F.trim(c.cast("string"))
    if isinstance(target, T.DateType):
        if isinstance(src_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.to_date(c)
        return F.try_to_date(F.trim(c.cast("string")), "yyyyMMdd")
    if isinstance(src_type, T.StringType):
        out = F.trim(c).try_cast(target)
    else:
        out = c.try_cast(target)
    default = column_default(col)
    if default is not None:
        out = F.coalesce(out, F.lit(default).cast(target))
    return out


def conform(raw: DataFrame, table: str, order_cols: list[str] | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select the table's key fields with canonical types (A2–A4).

    Missing optional columns become typed nulls, so all later code is
    column-unconditional.  ``_ord`` is a struct giving the source row order
    (file, position) used wherever the process keeps the "first" row.
    ``extra`` columns are passed through.
    """
    src = {c.strip().upper(): (c, raw.schema[c].dataType) for c in raw.columns}
    cols = []
    for col in table_columns(table):
        if col in src:
            name, dt = src[col]
            cols.append(_typed(F.col(f"`{name}`"), dt, col).alias(col))
        else:
            cols.append(F.lit(None).cast(column_type(col)).alias(col))
    order_cols = order_cols or ["_src_file", "_src_ord"]
    cols.append(F.struct(*[F.col(c) for c in order_cols]).alias("_ord"))
    return raw.select(*cols, *extra)


# --------------------------------------------------------------------------
# text extracts
# --------------------------------------------------------------------------

def _hadoop_paths(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    if found is None:
        return []
    return sorted(str(s.getPath().toString()) for s in found if s.isFile())


def _part_state(spark: SparkSession, paths: list[str]) -> list[tuple]:
    """(path, length, modification time) of each part."""
    out = []
    for p in paths:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        st = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hpath)
        out.append((p, st.getLen(), st.getModificationTime()))
    return out


def _written(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath))


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        line = reader.readLine()
        return "" if line is None else str(line).lstrip("﻿")
    finally:
        stream.close()


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob on any cluster file system."""
    return _hadoop_paths(spark, pattern)


def list_parts(spark: SparkSession, root: str, table: str) -> list[str]:
    """Main-table part files under ``root`` (A7: helper tables excluded)."""
    return _hadoop_paths(spark, f"{root.rstrip('/')}/{TABLE_FILE_GLOBS[table]}")


@dataclass
class ExtractRead:
    """Result of reading one table: typed rows and the malformed-row count."""

    df: DataFrame
    dropped: DataFrame  # rows with too many fields (one row per dropped line)


def read_extract(spark: SparkSession, paths: list[str], table: str,
                 encoding: str = "UTF-8", sep: str = EXTRACT_SEP, stage: str | None = "auto") -> ExtractRead:
    """Read the part files of one table.

    * header names are trimmed and upper-cased; only names that look like
      field names are kept (A8);
    * rows with more fields than the header are dropped and returned in
      ``dropped`` so the caller can count them; short rows are padded with
      nulls (A5);
    * ``_src_file`` / ``_src_ord`` record file order for "keep first" rules;
    * ``stage``: the parsed and *typed* rows are written once as Parquet and
      both outputs are read from it, so later reads get column pruning and
      pushdown (the invoice period reaches the scan).  "auto" names the folder
      under the shared checkpoint folder by the parts' names, sizes and times:
      a later read of the same parts uses it, changed parts get a new one.
      ``None`` keeps everything lazy on the text.
    """
    if not paths:
        raise FileNotFoundError(f"no part files for {table}")
    path = None
    if stage is not None:
        state = repr((_part_state(spark, sorted(paths)), encoding, sep))
        path = (stage_dir(spark, f"extract/{table}-{hashlib.sha256(state.encode()).hexdigest()[:24]}") if stage == "auto"
                else stage.rstrip("/"))
    if path is None or stage != "auto" or not _written(spark, path):
        raw = _parse(spark, paths, encoding, sep)
        typed = conform(raw, table, extra=("_bad", "_src_file", "_line"))
        if path is not None:
            typed.write.mode("overwrite").partitionBy("_bad").parquet(path)
    if path is not None:
        typed = spark.read.parquet(path)
    bad = F.col("_bad").cast("boolean")  # a folder name once it is written
    return ExtractRead(typed.where(~bad).drop("_bad", "_src_file", "_line"),
                       typed.where(bad).select(F.lit(table).alias("table"), "_src_file", F.col("_line").alias("line")))


def _parse(spark: SparkSession, paths: list[str], encoding: str, sep: str) -> DataFrame:
    """The rows of all parts as text columns, parts of one header line together."""
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault(_first_line(spark, p, encoding), []).append(p)
    frames = []
    for header, files in groups.items():
        names = [h.strip().upper() for h in header.split(sep)]
        # unique positional names, keep only field-like ones later
        fields = [f"_c{i}" for i in range(len(names))]
        schema = T.StructType([T.StructField(f, T.StringType(), True) for f in fields]
                              + [T.StructField(CORRUPT, T.StringType(), True)])
        df = (spark.read.schema(schema)
              .option("header", True)
              .option("sep", sep)
              .option("quote", "\u0000")
              .option("escape", "\u0000")
              .option("encoding", encoding)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("nullValue", "")
              .csv(files))
        too_long = F.col(CORRUPT).isNotNull() & (F.size(F.split(F.col(CORRUPT), re.escape(sep))) > len(names))
        keep = [F.col(f).alias(nm) for f, nm in zip(fields, names) if _NAME_OK.match(nm)]
        frames.append(df.select(
            *keep, too_long.alias("_bad"), F.when(too_long, F.col(CORRUPT)).alias("_line"),
            F.col("_metadata.file_path").alias("_src_file"),
            F.struct(F.col("_metadata.file_block_start").alias("_src_block"),
                     F.monotonically_increasing_id().alias("_src_row")).alias("_src_ord")))
    raw = frames[0]
    for f in frames[1:]:
        raw = raw.unionByName(f, allowMissingColumns=True)
    return raw


def read_table(spark: SparkSession, root: str, table: str, encoding: str = "UTF-8",
               stage: str | None = "auto") -> ExtractRead:
    """All parts of ``table`` under the folder ``root``."""
    return read_extract(spark, list_parts(spark, root, table), table, encoding, stage=stage)


def write_extract(df: DataFrame, path: str, sep: str = EXTRACT_SEP, encoding: str = "UTF-8") -> None:
    """Write a DataFrame as a ``#|#`` text extract (used for round trips)."""
    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyyMMdd")  # the extracts' own date format
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    fields = [f for f in df.schema.fields if not f.name.startswith("_")]
    (df.select(*[text(f) for f in fields])
       .write.mode("overwrite")
       .option("header", True).option("sep", sep).option("quote", "\u0000").option("escape", "\u0000")
       .option("encoding", encoding).option("emptyValue", "")
       .csv(path))
