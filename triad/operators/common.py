"""Small relational helpers shared by the document operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import Params
from ..functions.exprs import blank_ref, sold_to_norm

KEY = ["VKORG", "VBELN", "POSNR"]
# Documents are matched inside one company, so it is part of every key.
CKEY = ["company", *KEY]
# The same key in the order used for grouping, partitioning and joining:
# the high-cardinality column first, so sorts (sort-merge joins, windows)
# decide on the sort prefix instead of comparing full rows (VKORG has few
# values, MANDT one).
JKEY = ["VBELN", "POSNR", "VKORG", "company"]


def header_join(lines: DataFrame, header: DataFrame, keys=("VBELN", "MANDT")) -> DataFrame:
    """Lines left-joined to their header on (MANDT, VBELN).

    On a name clash the line value wins; where the line cell is null the
    header value fills it (all key-field columns exist after conform, so a
    column that was not extracted is an all-null column, not an absent one).
    """
    keys = list(keys)
    shared = [c for c in header.columns if c in lines.columns and c not in keys and c != "_ord"]
    only_hdr = [c for c in header.columns if c not in lines.columns]
    h = header.select(*keys, *[F.col(c).alias(f"_h_{c}") for c in shared], *only_hdr)
    j = lines.join(h, keys, "left")
    return j.select(
        *[F.coalesce(F.col(c), F.col(f"_h_{c}")).alias(c) if c in shared else F.col(c) for c in lines.columns],
        *only_hdr,
    )


def keep_first(df: DataFrame, keys: list[str], order: str = "_ord") -> DataFrame:
    """First row per key in source order (window, no collect)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def exclusion_set(spark: SparkSession, p: Params, vbak: DataFrame | None = None,
                  vbrk: DataFrame | None = None) -> DataFrame:
    """G1: sold-to codes to exclude, one column ``code``.

    = fixed list ∪ (4-digit company codes present in the data, when enabled)
      − removals.  Its size is bounded by the fixed list plus at most 9 000
      four-digit codes, so it is always safe to broadcast.
    """
    static = spark.createDataFrame([(c,) for c in p.static_exclusions], "code string")
    if not p.exclude_own_company_codes or vbak is None:
        return static
    parts = [vbak.select(F.col("BUKRS_VF").alias("code"))]
    if vbrk is not None:
        parts.append(vbrk.select(F.col("BUKRS").alias("code")))
    own = reduce(DataFrame.unionByName, parts).where(F.col("code").rlike("^[0-9]{4}$"))
    removed = spark.createDataFrame([(c,) for c in p.sold_to_exclude_remove], "code string")
    return static.unionByName(own).distinct().join(F.broadcast(removed), "code", "left_anti")


def drop_excluded(df: DataFrame, col: str, excl: DataFrame) -> DataFrame:
    """Drop rows whose normalised sold-to code is in the exclusion set."""
    return (df.withColumn("_sold_to", sold_to_norm(col))
              .join(F.broadcast(excl.select(F.col("code").alias("_sold_to"))), "_sold_to", "left_anti")
              .drop("_sold_to"))


def company_column(df: DataFrame, org: str = "VKORG") -> Column:
    """The company that the header join brought, else the sales organisation."""
    return F.col("company") if "company" in df.columns else F.col(org).alias("company")


def non_null_keys(df: DataFrame, cols=KEY) -> DataFrame:
    """Group-by on a null key drops the row in the process (pivot semantics)."""
    cond: Column = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(cond)


def doc_list(col: str, key: str = "VBELN") -> Column:
    """Distinct, sorted, ', '-joined document numbers of a group.  All
    documents without any reference share the blank key; their numbers are not
    bounded by one order line, so they are no cell but the rows of
    :func:`unreferenced_documents`."""
    v = F.when(~blank_ref(key), F.nullif(F.trim(F.col(col)), F.lit("")))
    return F.array_join(F.array_sort(F.collect_set(v)), ", ")


def unreferenced_documents(lines: DataFrame) -> DataFrame:
    """The documents of lines without any order reference, one row each."""
    open_ = lines.where(blank_ref("ORD_VBELN"))
    return open_.select(company_column(open_), "VKORG", F.trim(F.col("VBELN")).alias("doc")).distinct()


def first_non_null(col: str, order: str = "_ord") -> Column:
    """First non-null value in source order (pandas ``first``)."""
    return F.min_by(F.col(col), F.struct(F.col(col).isNull(), F.col(order)))
