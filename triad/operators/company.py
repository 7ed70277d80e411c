"""Company dimension: VKORG->BUKRS map (A9), header/line company assignment
(A10–A12), code listing (A14) and the company column of results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..session import written

UNKNOWN = "UNKNOWN"
UNMAPPED = "UNMAPPED"
# The VKORG -> company map is broadcast only when it has been counted and is
# this small; dirty data can hold any VKORG text.
MAP_BROADCAST_ROWS = 100_000


def _code(c: str):
    """Trimmed code; blank / 'nan' text -> null."""
    t = F.trim(F.col(c))
    return F.when(t.isNull() | (t == "") | (F.upper(t) == "NAN"), F.lit(None)).otherwise(t)


def vkorg_company(vbak: DataFrame, vbrk: DataFrame) -> DataFrame:
    """VKORG -> BUKRS from VBAK (BUKRS_VF) then VBRK (BUKRS); the last
    pair seen wins, VBRK after VBAK, file order within a table.

    The result has one row per sales organisation.  It is small in
    practice, but dirty data can hold any VKORG text, so joins to it carry
    no broadcast hint: AQE broadcasts it at runtime when its measured size is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the
    sort-merge join otherwise.
    """
    a = vbak.select(_code("VKORG").alias("VKORG"), _code("BUKRS_VF").alias("BUKRS"),
                    F.lit(0).alias("_rank"), "_ord")
    b = vbrk.select(_code("VKORG").alias("VKORG"), _code("BUKRS").alias("BUKRS"),
                    F.lit(1).alias("_rank"), "_ord")
    u = a.unionByName(b).where(F.col("VKORG").isNotNull() & F.col("BUKRS").isNotNull())
    return u.groupBy("VKORG").agg(F.max_by("BUKRS", F.struct("_rank", "_ord")).alias("BUKRS"))


def assign_company_header(df: DataFrame, table: str, by: str = "bukrs",
                          bmap: DataFrame | None = None) -> DataFrame:
    """Company of each header row (column ``company``).

    by="bukrs": VBAK by BUKRS_VF, LIKP by VKORG through the map, VBRK by
    BUKRS.  by="vkorg": every header by VKORG.  Blank -> UNKNOWN, not in the
    map -> UNMAPPED; callers drop both (and may count them).
    """
    if by == "vkorg":
        code = _code("VKORG")
        return df.withColumn("company", F.coalesce(code, F.lit(UNKNOWN)))
    if table == "VBAK":
        return df.withColumn("company", F.coalesce(_code("BUKRS_VF"), F.lit(UNKNOWN)))
    if table == "VBRK":
        return df.withColumn("company", F.coalesce(_code("BUKRS"), F.lit(UNKNOWN)))
    if table == "LIKP":
        assert bmap is not None, "LIKP needs the VKORG->BUKRS map"
        m = bmap.select(F.col("VKORG").alias("_mv"), F.col("BUKRS").alias("_mb"))
        j = df.withColumn("_vk", _code("VKORG")).join(m, F.col("_vk") == F.col("_mv"), "left")
        comp = (F.when(F.col("_vk").isNull(), F.lit(UNKNOWN))
                 .when(F.col("_mb").isNull(), F.lit(UNMAPPED)).otherwise(F.col("_mb")))
        return j.withColumn("company", comp).drop("_vk", "_mv", "_mb")
    raise ValueError(table)


def company_headers(t: dict[str, DataFrame], by: str) -> dict[str, DataFrame]:
    """VBAK, LIKP and VBRK with ``company`` (UNKNOWN and UNMAPPED kept): the one place that says
    which company a header belongs to, for the split and for the match.

    By company code VBAK falls back to its VKORG if the extract has no BUKRS_VF
    at all.  The map for LIKP is counted and broadcast, so no header is shuffled
    on VKORG.
    """
    bmap, coded = None, True
    if by != "vkorg":
        bmap = written(vkorg_company(t["VBAK"], t["VBRK"]), "company-map")
        if bmap.count() <= MAP_BROADCAST_ROWS:
            bmap = F.broadcast(bmap)
        coded = not t["VBAK"].where(_code("BUKRS_VF").isNotNull()).isEmpty()
    return {h: assign_company_header(t[h], h, "vkorg" if h == "VBAK" and not coded else by, bmap) for h in ("VBAK", "LIKP", "VBRK")}


def tag_headers(t: dict[str, DataFrame], p: Params) -> dict[str, DataFrame]:
    """The six tables with ``company`` on the headers, as the match uses them.

    By sales organisation every header keeps its VKORG.  By company code headers
    without a company go, and of a number with several companies the last header
    row decides (A10, A11); only such numbers, found by one combined count, are
    looked up again, so a number that very many headers share is no hot key.
    Lines get the company with their header, never by a join on VKORG.
    """
    out = dict(t)
    if p.company_by == "vkorg":
        for h in ("VBAK", "LIKP", "VBRK"):
            out[h] = t[h].withColumn("company", F.col("VKORG"))
        return out
    for h, d in company_headers(t, p.company_by).items():
        d = d.where(~F.col("company").isin(UNKNOWN, UNMAPPED))
        several = d.groupBy(F.trim(F.col("VBELN")).alias("_hv")).agg(
            F.min("company").alias("_min"), F.max("company").alias("_max"), F.max_by("company", "_ord").alias("_last"))
        several = several.where("_min <> _max").select("_hv", "_last")
        d = d.join(several, F.trim(F.col("VBELN")) == F.col("_hv"), "left")
        out[h] = d.where(F.col("_last").isNull() | (F.col("company") == F.col("_last"))).drop("_hv", "_last")
    return out


def header_companies(tagged: dict[str, DataFrame]) -> DataFrame:
    """The companies of the document headers, one column."""
    parts = [tagged[h].select("company") for h in ("VBAK", "LIKP", "VBRK")]
    return reduce(DataFrame.unionByName, parts).where("company <> ''").distinct()


def dropped_rows(t: dict[str, DataFrame], by: str = "bukrs") -> DataFrame:
    """Rows of each table that the split keeps, and that have no company
    (UNKNOWN) or none in the map or the headers (UNMAPPED)."""
    tagged = split_tables(t, by)
    status = F.when(F.col("company").isin(UNKNOWN, UNMAPPED), F.col("company")).otherwise("kept")
    parts = [d.select(F.lit(n).alias("table"), status.alias("status")) for n, d in tagged.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("table", "status").agg(F.count(F.lit(1)).alias("rows"))


def select_companies(codes: DataFrame, companies: list[str] | None = None, start: str | None = None,
                     skip: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The companies of a run, one column ``company`` in code order: the
    listed ones or all, from ``start`` on, without ``skip``, the first ``limit``."""
    d = codes.select("company").distinct()
    if companies is not None:
        d = d.where(F.col("company").isin(*companies))
    if start is not None:
        d = d.where(F.col("company") >= start)
    if skip:
        d = d.where(~F.col("company").isin(*skip))
    return d if limit is None else d.orderBy("company").limit(limit)


def header_company_map(headers: DataFrame) -> DataFrame:
    """VBELN -> company of the kept header rows; the last row wins."""
    kept = headers.where(~F.col("company").isin(UNKNOWN, UNMAPPED))
    return (kept.groupBy(F.trim(F.col("VBELN")).alias("_hv"))
                .agg(F.max_by("company", F.col("_ord")).alias("_hc")))


def assign_company_line(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Each line gets its header's company by VBELN; unmapped lines get
    UNMAPPED (count them, then drop)."""
    m = header_company_map(headers)
    j = lines.join(m, F.trim(F.col("VBELN")) == F.col("_hv"), "left")
    return j.withColumn("company", F.coalesce(F.col("_hc"), F.lit(UNMAPPED))).drop("_hv", "_hc")


def split_tables(t: dict[str, DataFrame], by: str = "bukrs") -> dict[str, DataFrame]:
    """A10–A12 over all six tables: every row tagged with ``company``;
    UNKNOWN / UNMAPPED rows are kept here so they can be counted."""
    headers = company_headers(t, by)
    out = {}
    for hdr, line in (("VBAK", "VBAP"), ("LIKP", "LIPS"), ("VBRK", "VBRP")):
        out[hdr] = headers[hdr]
        out[line] = assign_company_line(t[line], headers[hdr])
    return out


def list_codes(vbak: DataFrame, vbrk: DataFrame) -> DataFrame:
    """Distinct company codes and sales organisations in the data
    (over all files, not a sample).  Columns (kind, code)."""
    bukrs = (vbak.select(_code("BUKRS_VF").alias("code"))
             .unionByName(vbrk.select(_code("BUKRS").alias("code"))))
    vkorg = (vbak.select(_code("VKORG").alias("code"))
             .unionByName(vbrk.select(_code("VKORG").alias("code"))))
    return (bukrs.withColumn("kind", F.lit("BUKRS"))
            .unionByName(vkorg.withColumn("kind", F.lit("VKORG")))
            .where(F.col("code").isNotNull()).distinct().select("kind", "code"))
