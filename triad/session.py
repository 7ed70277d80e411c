"""SparkSession construction and the shared checkpoint / staging folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session settings the pipeline relies on.  ANSI stays on (Spark 4 default):
# raw text goes through try_cast / try_to_date, so bad cells become null
# instead of failing the job.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Runtime bloom filters prune the big side of the semi/anti joins.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Company codes are text (leading zeros matter): never infer partition
    # column types when stage datasets are read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Multi-byte code pages (GBK extracts) need the legacy charset switch.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "triad", extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local/test session; on a cluster use the cluster's own builder."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the folder is a shared one the cluster names in
    ``spark.checkpoint.dir``; a machine-local temporary folder is used only
    for a local master (tests, single-machine runs).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="triad-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def stage_dir(spark: SparkSession, name: str) -> str:
    """A folder for a written stage table under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "stages", name)


#: Spark keeps a query's shuffle files until the driver happens to collect its garbage, unless told otherwise.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: its rows are on the shared disk, nothing
    reads them from a shuffle again.  The session's own setting is back afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


#: Stages that a run only passes through are read once or twice; they take less of the disk.
SCRATCH_CODEC = "zstd"


def scratch_folder(spark: SparkSession, name: str) -> str:
    return stage_dir(spark, f"scratch/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read again: what
    follows reads columns from there, and a lost executor repeats nothing before it.
    ``path``: a folder of the caller's, who removes it when nothing reads it any more."""
    path = path or scratch_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """A folder of the shared file system goes, with all in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def distributed_numbers(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """``df`` with the 1-based place of each row in ``order`` over all rows, numbered where the
    rows are: range partitions are sorted and written, their sizes (one row to a partition)
    summed up, and each row adds its place in its partition.  Ties are numbered in any
    order.  The result is not itself sorted across files."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    d = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    # checkpointed partitions keep their numbers and order
    d = d.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    sizes = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy(
        F.col("a._part").alias("_part")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return d.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")
