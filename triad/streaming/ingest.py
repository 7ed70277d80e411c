"""Incremental ingest of new extract parts with Structured Streaming.

New ``<TABLE>_<n>.TXT`` parts dropped into a landing folder are found by a
file-source stream with ``trigger(availableNow=True)``: each run takes every part
that arrived since the last one and stops, and the checkpoint (under the shared
checkpoint folder) remembers which parts are done.  The stream carries only file
names; the parts of a micro-batch are read by the batch reader
(:func:`triad.sources.extract.read_extract`), so headers are read part by part,
parts of different layouts go together, and types, the malformed-row rule and the
file order are those of a batch read.

A micro-batch replaces its own folder ``ingest_batch=<id>``.  ``foreachBatch`` may
run a batch again whose commit was lost; the second run writes the same rows to
the same place, so no part is skipped or repeated.  A new checkpoint needs a new
output folder.

The stored company of a line is what the headers said at ingest; a line whose header
is not there yet goes to the folder ``company=UNMAPPED`` of its batch.  These
folders are the index of late lines: :func:`settle` joins them alone, never the
lines already settled, with the headers ingested by now.  Lines that find their company
are added to the settled ones, the others are the next generation's late lines, and
one small manifest makes the generation visible, so a settling that stops or runs
again changes nothing.  :func:`read_settled` then reads without any join.
:func:`read_ingested` assigns every company anew, for headers that have changed.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import EXTRACT_SEP, TABLE_FILE_GLOBS
from ..plans import stages as ST
from ..operators.company import UNKNOWN, UNMAPPED, assign_company_header, assign_company_line, vkorg_company
from ..session import stage_dir
from ..sources.extract import read_extract


def ingest_stream(spark: SparkSession, landing: str, table: str, out: str, company_col: str | None = None,
                  company_map: str | None = None, checkpoint: str | None = None, encoding: str = "UTF-8",
                  sep: str = EXTRACT_SEP, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start (and, with ``availableNow``, finish) one incremental ingest run.

    * ``company_col``: header tables — the company is this column's value;
    * ``company_map``: line tables — path of an ingested header table whose
      ``(VBELN, company)`` pairs assign the company (lines whose header is not
      ingested yet, or LIKP, which has no company of its own, are stored as
      ``UNMAPPED``; see :func:`settle`);
    * rows with more fields than the header are dropped (A5), as in batch.
    """
    reader = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", os.path.basename(TABLE_FILE_GLOBS[table])))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parts = sorted(r.path for r in batch.collect())  # file names of this batch only
        if not parts:
            return
        df = read_extract(batch.sparkSession, parts, table, encoding, sep, stage=None).df
        if company_col is not None:
            code = F.nullif(F.trim(F.col(company_col)), F.lit(""))
            df = df.withColumn("company", F.coalesce(code, F.lit(UNKNOWN)))
        elif company_map is not None:
            df = assign_company_line(df, _ingested(batch.sparkSession, company_map))
        else:
            df = df.withColumn("company", F.lit(UNMAPPED if table == "LIKP" else "ALL"))
        # _ord (file, position) is stored so "keep first" works on the table
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("company")
           .parquet(f"{out.rstrip('/')}/ingest_batch={batch_id}"))

    checkpoint = checkpoint or stage_dir(spark, f"ingest-checkpoint/{table}")
    return (reader.load(landing).select("path").writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_ingested(spark: SparkSession, out: str, headers: str | None = None, vbak: str | None = None,
                  vbrk: str | None = None) -> DataFrame:
    """The ingested table with its company as of now.

    ``headers``: of a line table, the path of its ingested header table;
    ``vbak`` and ``vbrk``: of LIKP, the paths that give VKORG -> company.
    """
    df = _ingested(spark, out)
    if headers is not None:
        return assign_company_line(df.drop("company"), _ingested(spark, headers))
    if vbak is not None and vbrk is not None:
        bmap = vkorg_company(_ingested(spark, vbak), _ingested(spark, vbrk))
        return assign_company_header(df.drop("company"), "LIKP", "bukrs", bmap)
    return df


def _late(spark: SparkSession, out: str) -> tuple[int, list[int], dict | None]:
    """The last generation, the batches after those it covers, and its manifest."""
    base = out.rstrip("/")
    names = [n for n in ST.list_names(spark, f"{base}/{ST.MANIFEST}") if n[0].isdigit()]
    last = json.loads(ST.read_text(spark, f"{base}/{ST.MANIFEST}/{names[-1]}")) if names else None
    batches = sorted(int(n.split("=")[1]) for n in ST.list_names(spark, base) if n.startswith("ingest_batch="))
    return len(names), [b for b in batches if last is None or b > last["batch"]], last


def _batches(spark: SparkSession, out: str, batches: list[int], schema: T.StructType) -> DataFrame:
    folders = [f"{out.rstrip('/')}/ingest_batch={b}" for b in batches]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", out).parquet(*folders).select(schema.names)


def _schema(spark: SparkSession, out: str) -> T.StructType:
    fields = [f for f in spark.read.parquet(out).schema.fields if f.name not in ("company", "ingest_batch")]
    return T.StructType([*fields, T.StructField("company", T.StringType())])


def _ingested(spark: SparkSession, out: str) -> DataFrame:
    """The table as it was ingested.  Company codes are text, whatever a session makes of folder names."""
    schema = T.StructType([*_schema(spark, out).fields, T.StructField("ingest_batch", T.IntegerType())])
    return spark.read.schema(schema).parquet(out)


def settle(spark: SparkSession, out: str, headers: str | None = None, vbak: str | None = None, vbrk: str | None = None) -> int:
    """Give late lines their company: from the ingested header table ``headers`` (line tables), or
    through the VKORG map of the ingested ``vbak`` and ``vbrk`` (LIKP).  Reads the late
    lines only.  Returns the number of the generation."""
    base = out.rstrip("/")
    done, fresh, last = _late(spark, out)
    if last is None and not fresh:
        return 0
    schema = _schema(spark, out)
    late = _batches(spark, out, fresh, schema).where(F.col("company") == UNMAPPED)
    if last is not None:
        late = late.unionByName(spark.read.schema(schema).parquet(f"{base}/{last['late']}"))
    late = late.drop("company")
    if headers is not None:
        late = assign_company_line(late, _ingested(spark, headers))
    else:
        late = assign_company_header(late, "LIKP", "bukrs", vkorg_company(_ingested(spark, vbak), _ingested(spark, vbrk)))
    made = f"_settled-{uuid.uuid4().hex}"
    late.select(schema.names).withColumn("late", F.col("company") == UNMAPPED).write.partitionBy("late").parquet(f"{base}/{made}")
    entry = {"batch": max([*fresh, last["batch"] if last else -1]), "late": f"{made}/late=true",
             "settled": [*(last["settled"] if last else []), f"{made}/late=false"]}
    for part in (entry["late"], entry["settled"][-1]):          # a folder that got no row
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{part}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    ST.publish_text(spark, f"{base}/{ST.MANIFEST}", json.dumps(entry), lambda names: f"{done + 1:010d}-settled.json")
    return done + 1


def read_settled(spark: SparkSession, out: str) -> DataFrame:
    """The ingested table with the companies settled by now; late lines are UNMAPPED.  No join."""
    base = out.rstrip("/")
    _, fresh, last = _late(spark, out)
    schema = _schema(spark, out)
    every = sorted(int(n.split("=")[1]) for n in ST.list_names(spark, base) if n.startswith("ingest_batch="))
    if last is None:
        return _batches(spark, out, every, schema)
    covered = _batches(spark, out, [b for b in every if b not in fresh], schema).where(F.col("company") != UNMAPPED)
    parts = [covered, _batches(spark, out, fresh, schema)]
    parts += [spark.read.schema(schema).parquet(f"{base}/{p}") for p in (*last["settled"], last["late"])]
    return reduce(DataFrame.unionByName, parts)


__all__ = ["UNKNOWN", "UNMAPPED", "ingest_stream", "read_ingested", "read_settled", "settle"]
