"""Registered queries: one per operator of the inventory, each paired with
its DuckDB oracle statement.

Every query reads the driver's star-schema tables at ``sf_dir``, derives the
six SAP-shaped tables from them (``sources.fixtures``) and runs the real
operator over the whole tables.  Outputs are normalised for comparison:
decimals -> double, small ints -> bigint, dates -> ISO text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..config import SCENARIO_LABELS, fixture_params
from ..functions import exprs as X
from ..operators import common as C
from ..operators import company as CO
from ..operators import deliveries as DV
from ..operators import invoices as IV
from ..operators import matching as M
from ..operators import orders as OR
from ..operators import report as R
from ..operators import scenarios as S
from ..operators import verify as V
from ..session import stage_dir, written
from ..sources import extract as EX
from ..sources.extract import write_extract
from ..sources.fixtures import fixture_tables
from . import pipeline as PL


def export(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Ctx:
    """Lazily built stages of one (spark, sf_dir) evaluation."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.p = spark, sf_dir, fixture_params()

    @cached_property
    def t(self):
        return fixture_tables(self.spark, self.sf_dir)

    @cached_property
    def excl(self):
        return C.exclusion_set(self.spark, self.p, self.t["VBAK"], self.t["VBRK"])

    @cached_property
    def known(self):
        return DV.known_orders(self.t["VBAK"])

    @cached_property
    def rec(self):
        return PL.reconcile(self.spark, self.t, self.p)

    @cached_property
    def stored(self):
        """The match for queries that read all of it, from pivots written one after the other."""
        return PL.reconcile_stored(self.spark, self.t, self.p)

    @cached_property
    def an(self):
        return PL.analyse(self.rec, self.p)

    @cached_property
    def st(self):
        """The analysis for queries that read the statistics."""
        return PL.analyse(PL.reconcile_figures(self.spark, self.t, self.p), self.p)

    @cached_property
    def order_lines(self):
        return OR.order_lines(self.t["VBAK"], self.t["VBAP"], self.excl, self.p)

    @cached_property
    def delivery_lines(self):
        return DV.delivery_lines(self.t["LIKP"], self.t["LIPS"], self.known, self.p)

    @cached_property
    def invoice_lines(self):
        return IV.invoice_lines(self.t["VBRK"], self.t["VBRP"], self.excl, self.p)


Query = Callable[[Ctx], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def q(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, None if sql is None else O.with_chain(sql))
        return fn
    return deco


MATCH_COLS = ["company", "VKORG", "VBELN", "POSNR", "AUART", "inv_docs", "inv_type", "dlv_docs", "inv_qty", "inv_amt",
              "dlv_qty", "ord_qty", "ord_amt_lc", "ord_amt_fc", "MATNR", "ARKTX", "amt_diff", "od_qty_diff",
              "oi_qty_diff", "di_qty_diff", "delivery_missing", "order_missing", "is_negative"]
_MATCH_SQL_COLS = ", ".join(
    (f"{c}::DOUBLE AS {c}" if c in ("inv_qty", "inv_amt", "dlv_qty", "ord_qty", "ord_amt_lc", "ord_amt_fc",
                                    "amt_diff", "od_qty_diff", "oi_qty_diff", "di_qty_diff") else c)
    for c in MATCH_COLS)

# ---------------------------------------------------------------------------
# A: sources / company split
# ---------------------------------------------------------------------------


@q("a9_vkorg_bukrs_map", """
SELECT VKORG, BUKRS FROM (
  SELECT VKORG, BUKRS, row_number() OVER (PARTITION BY VKORG ORDER BY r DESC, o DESC) rn FROM (
    SELECT trim(VKORG) VKORG, trim(BUKRS_VF) BUKRS, 0 r, VBELN o FROM vbak
    UNION ALL SELECT trim(VKORG), trim(BUKRS), 1, VBELN FROM vbrk) u
  WHERE VKORG IS NOT NULL AND VKORG <> '' AND BUKRS IS NOT NULL AND BUKRS <> '') WHERE rn = 1""")
def a9(c: Ctx):
    return CO.vkorg_company(c.t["VBAK"], c.t["VBRK"])


_HDR_SQL = """
SELECT 'VBAK' AS "table", VBELN, coalesce(nullif(trim(BUKRS_VF),''),'UNKNOWN') company FROM vbak
UNION ALL SELECT 'LIKP', VBELN, coalesce(m.BUKRS, 'UNMAPPED') FROM likp LEFT JOIN (
  SELECT VKORG, BUKRS FROM (SELECT VKORG, BUKRS, row_number() OVER (PARTITION BY VKORG ORDER BY r DESC, o DESC) rn
   FROM (SELECT VKORG, BUKRS_VF BUKRS, 0 r, VBELN o FROM vbak UNION ALL SELECT VKORG, BUKRS, 1, VBELN FROM vbrk) u)
   WHERE rn = 1) m USING (VKORG)
UNION ALL SELECT 'VBRK', VBELN, coalesce(nullif(trim(BUKRS),''),'UNKNOWN') FROM vbrk"""


@q("a10_split_headers", _HDR_SQL)
def a10(c: Ctx):
    s = CO.split_tables(c.t, "bukrs")
    return C_union([s[h].select(F.lit(h).alias("table"), "VBELN", "company") for h in ("VBAK", "LIKP", "VBRK")])


@q("a11_split_lines", f"""
, hc AS ({_HDR_SQL})
SELECT l."table", l.VBELN, l.POSNR, coalesce(h.company, 'UNMAPPED') company FROM (
  SELECT 'VBAP' AS "table", 'VBAK' AS ht, VBELN, POSNR FROM vbap UNION ALL SELECT 'LIPS', 'LIKP', VBELN, POSNR FROM lips
  UNION ALL SELECT 'VBRP', 'VBRK', VBELN, POSNR FROM vbrp) l
LEFT JOIN (SELECT DISTINCT "table", VBELN, company FROM hc WHERE company NOT IN ('UNKNOWN','UNMAPPED')) h
  ON h."table" = l.ht AND h.VBELN = l.VBELN""")
def a11(c: Ctx):
    s = CO.split_tables(c.t, "bukrs")
    return C_union([s[t].select(F.lit(t).alias("table"), "VBELN", "POSNR", "company") for t in ("VBAP", "LIPS", "VBRP")])


@q("a12_split_by_vkorg", """
SELECT 'VBAK' AS "table", VBELN, VKORG company FROM vbak UNION ALL SELECT 'LIKP', VBELN, VKORG FROM likp
UNION ALL SELECT 'VBRK', VBELN, VKORG FROM vbrk
UNION ALL SELECT 'VBAP', l.VBELN, coalesce(h.VKORG, 'UNMAPPED') FROM vbap l LEFT JOIN vbak h USING (VBELN)
UNION ALL SELECT 'LIPS', l.VBELN, coalesce(h.VKORG, 'UNMAPPED') FROM lips l LEFT JOIN likp h USING (VBELN)
UNION ALL SELECT 'VBRP', l.VBELN, coalesce(h.VKORG, 'UNMAPPED') FROM vbrp l LEFT JOIN vbrk h USING (VBELN)""")
def a12(c: Ctx):
    s = CO.split_tables(c.t, "vkorg")
    return C_union([s[t].select(F.lit(t).alias("table"), "VBELN", "company") for t in CO_TABLES])


@q("a14_list_codes", """
SELECT DISTINCT kind, code FROM (
  SELECT 'BUKRS' kind, BUKRS_VF code FROM vbak UNION ALL SELECT 'BUKRS', BUKRS FROM vbrk
  UNION ALL SELECT 'VKORG', VKORG FROM vbak UNION ALL SELECT 'VKORG', VKORG FROM vbrk) WHERE code IS NOT NULL""")
def a14(c: Ctx):
    return CO.list_codes(c.t["VBAK"], c.t["VBRK"])


CO_TABLES = ("VBAK", "LIKP", "VBRK", "VBAP", "LIPS", "VBRP")


def C_union(frames):
    return S.union_all(frames)


# ---------------------------------------------------------------------------
# B: expressions (each over the whole table it applies to)
# ---------------------------------------------------------------------------

@q("b1_blank_ref", f"""
SELECT VBELN, POSNR, VBELV, VGBEL, {O.B('VBELV')} vbelv_blank, {O.B('VGBEL')} vgbel_blank FROM lips""")
def b1(c: Ctx):
    d = c.t["LIPS"]
    return d.select("VBELN", "POSNR", "VBELV", "VGBEL", X.blank_ref("VBELV").alias("vbelv_blank"),
                    X.blank_ref("VGBEL").alias("vgbel_blank"))


@q("b2_blank_parent_ref", f"""
SELECT VBELN, POSNR, UEPOS, UECHA, {O.BP('UEPOS')} AND {O.BP('UECHA')} is_parent FROM lips""")
def b2(c: Ctx):
    d = c.t["LIPS"]
    return d.select("VBELN", "POSNR", "UEPOS", "UECHA",
                    (X.blank_parent_ref("UEPOS") & X.blank_parent_ref("UECHA")).alias("is_parent"))


@q("b3_delivery_order_key", f"""
SELECT VBELN, POSNR, CASE WHEN {O.B('VBELV')} THEN VGBEL ELSE VBELV END ORD_VBELN,
  CASE WHEN {O.B('POSNV')} THEN VGPOS ELSE POSNV END ORD_POSNR FROM lips""")
def b3(c: Ctx):
    d = c.t["LIPS"]
    return d.select("VBELN", "POSNR", X.fill_if_blank("VBELV", "VGBEL").alias("ORD_VBELN"),
                    X.fill_if_blank("POSNV", "VGPOS").alias("ORD_POSNR"))


@q("b4_invoice_order_key", f"""
SELECT VBELN, POSNR, CASE WHEN {O.B('AUBEL')} OR {O.B('AUPOS')} THEN VBELV ELSE AUBEL END ORD_VBELN,
  CASE WHEN {O.B('AUBEL')} OR {O.B('AUPOS')} THEN POSNV ELSE AUPOS END ORD_POSNR FROM vbrp""")
def b4(c: Ctx):
    d = c.t["VBRP"]
    no, item = X.invoice_order_key()
    return d.select("VBELN", "POSNR", no.alias("ORD_VBELN"), item.alias("ORD_POSNR"))


@q("b5_invoice_list_key", f"""
SELECT VBELN, POSNR, CASE WHEN {O.B('VBELV')} THEN AUBEL ELSE VBELV END order_no,
  CASE WHEN {O.B('POSNV')} THEN AUPOS ELSE POSNV END order_item FROM vbrp""")
def b5(c: Ctx):
    d = c.t["VBRP"]
    return d.select("VBELN", "POSNR", X.fill_if_blank("VBELV", "AUBEL").alias("order_no"),
                    X.fill_if_blank("POSNV", "AUPOS").alias("order_item"))


@q("b6_material_norm", """
SELECT VBELN, POSNR, MATNR, CASE WHEN regexp_full_match(trim(coalesce(MATNR,'')), '0*') THEN ''
  ELSE trim(coalesce(MATNR,'')) END material FROM vbap""")
def b6(c: Ctx):
    return c.t["VBAP"].select("VBELN", "POSNR", "MATNR", X.material_norm("MATNR").alias("material"))


@q("b7_sold_to_norm", f"SELECT VBELN, KUNNR, {O.ST('KUNNR')} sold_to FROM vbak")
def b7(c: Ctx):
    return c.t["VBAK"].select("VBELN", "KUNNR", X.sold_to_norm("KUNNR").alias("sold_to"))


@q("b8_sign_map", f"""
SELECT 'VBRP' AS src, VBELN, POSNR, SHKZG, {O.SG('SHKZG')}::BIGINT sign FROM vbrp
UNION ALL SELECT 'LIPS', VBELN, POSNR, SHKZG, {O.SG('SHKZG')}::BIGINT FROM lips""")
def b8(c: Ctx):
    a = c.t["VBRP"].select(F.lit("VBRP").alias("src"), "VBELN", "POSNR", "SHKZG", X.sign("SHKZG").alias("sign"))
    b = c.t["LIPS"].select(F.lit("LIPS").alias("src"), "VBELN", "POSNR", "SHKZG", X.sign("SHKZG").alias("sign"))
    return a.unionByName(b)


@q("b9_order_base_qty", f"""
SELECT VBELN, POSNR, MATNR, (CASE WHEN KLMENG IS NOT NULL AND abs(KLMENG) >= 0.000001 THEN KLMENG::DECIMAL(24,6)
  ELSE (coalesce(KWMENG,0) * coalesce(UMVKZ,1) / {O.NZ1('UMVKN')})::DECIMAL(24,6) END)::DOUBLE ord_qty FROM vbap""")
def b9(c: Ctx):
    return c.t["VBAP"].select("VBELN", "POSNR", "MATNR", X.order_base_qty(c.p).alias("ord_qty"))


@q("b10_delivery_base_qty", f"""
SELECT VBELN, POSNR, ((CASE WHEN abs(coalesce(LGMNG,0)) >= 0.000001 THEN LGMNG::DECIMAL(24,6)
  ELSE (coalesce(LFIMG,0) * {O.NZ1('UMVKN')} / {O.NZ1('UMVKZ')})::DECIMAL(24,6) END) * {O.SG('SHKZG')})::DOUBLE dlv_qty
FROM lips""")
def b10(c: Ctx):
    d = c.t["LIPS"]
    return d.select("VBELN", "POSNR", (X.base_qty("LGMNG", "LFIMG", c.p) * X.sign("SHKZG")).alias("dlv_qty"))


@q("b11_invoice_base_qty", f"""
SELECT VBELN, POSNR, ((CASE WHEN abs(coalesce(FKLMG,0)) >= 0.000001 THEN FKLMG::DECIMAL(24,6)
  ELSE (coalesce(FKIMG,0) * {O.NZ1('UMVKN')} / {O.NZ1('UMVKZ')})::DECIMAL(24,6) END) * {O.SG('SHKZG')})::DOUBLE inv_qty
FROM vbrp""")
def b11(c: Ctx):
    d = c.t["VBRP"]
    return d.select("VBELN", "POSNR", (X.base_qty("FKLMG", "FKIMG", c.p) * X.sign("SHKZG")).alias("inv_qty"))


@q("b12_order_amounts", """
SELECT VKORG, VBELN, POSNR, MATNR, ord_amt_fc::DOUBLE ord_amt_fc, ord_amt_lc::DOUBLE ord_amt_lc FROM ol""")
def b12(c: Ctx):
    return c.order_lines.select("VKORG", "VBELN", "POSNR", "MATNR", "ord_amt_fc", "ord_amt_lc")


@q("b13_invoice_amount", f"""
SELECT VBELN, POSNR, (coalesce(NETWR,0) * {O.SG('SHKZG')})::DOUBLE inv_amt FROM vbrp""")
def b13(c: Ctx):
    return c.t["VBRP"].select("VBELN", "POSNR", X.signed("NETWR").alias("inv_amt"))


@q("b14_list_sales_unit_qty", f"""
SELECT 'LIPS' src, VBELN, POSNR, (coalesce(LFIMG,0) * {O.SG('SHKZG')})::DOUBLE qty FROM lips
UNION ALL SELECT 'VBRP', VBELN, POSNR, (coalesce(FKIMG,0) * {O.SG('SHKZG')})::DOUBLE FROM vbrp""")
def b14(c: Ctx):
    a = c.t["LIPS"].select(F.lit("LIPS").alias("src"), "VBELN", "POSNR",
                           X.signed("LFIMG").alias("qty"))
    b = c.t["VBRP"].select(F.lit("VBRP").alias("src"), "VBELN", "POSNR",
                           X.signed("FKIMG").alias("qty"))
    return a.unionByName(b)


@q("b15_parse_order_date", f"SELECT VBELN, strftime({O.DT('AUDAT')}, '%Y-%m-%d') order_date FROM vbak")
def b15(c: Ctx):
    return c.t["VBAK"].select("VBELN", X.order_date().alias("order_date"))


@q("b16_invoice_period", f"""
SELECT VBELN, POSNR, strftime({O.DT('FKDAT')}, '%Y-%m-%d') FKDAT FROM vbrp
WHERE {O.DT('FKDAT')} BETWEEN DATE '{O._IF}' AND DATE '{O._IL}'""")
def b16(c: Ctx):
    return c.t["VBRP"].where(X.in_period("FKDAT", c.p.invoice_period)).select("VBELN", "POSNR", "FKDAT")


@q("b17_order_period", f"""
SELECT VBELN, strftime({O.DT('AUDAT')}, '%Y-%m-%d') order_date FROM vbak
WHERE {O.DT('AUDAT')} BETWEEN DATE '{O._OF}' AND DATE '{O._OL}'""")
def b17(c: Ctx):
    d = c.t["VBAK"].select("VBELN", X.order_date().alias("order_date"))
    return d.where(X.in_period("order_date", c.p.order_period))


@q("b18_order_type_filter", f"""
SELECT VBELN, AUART FROM vbak WHERE upper(trim(coalesce(AUART,''))) NOT IN ({O._TYPES_EXCL})""")
def b18(c: Ctx):
    return c.t["VBAK"].where(X.order_type_kept(c.p)).select("VBELN", "AUART")


@q("b19_nonzero_delivery", "SELECT VBELN, POSNR, LFIMG::DOUBLE LFIMG FROM lips WHERE abs(coalesce(LFIMG,0)) >= 0.000001")
def b19(c: Ctx):
    d = c.t["LIPS"]
    return d.where(X.nonzero("LFIMG", c.p)).select("VBELN", "POSNR", "LFIMG")


@q("b20_nonzero_invoice", """
SELECT VBELN, POSNR FROM vbrp WHERE abs(coalesce(FKIMG,0)) >= 0.000001 OR abs(coalesce(NETWR,0)) >= 0.000001""")
def b20(c: Ctx):
    d = c.t["VBRP"]
    return d.where(X.nonzero("FKIMG", c.p) | X.nonzero("NETWR", c.p)).select("VBELN", "POSNR")


@q("b21_delivery_unit", "SELECT VBELN, POSNR, '' qty_unit FROM lips")
def b21(c: Ctx):
    return c.t["LIPS"].select("VBELN", "POSNR", X.delivery_unit().alias("qty_unit"))


@q("b26_fill_round", "SELECT company, VKORG, VBELN, POSNR, inv_qty::DOUBLE inv_qty, inv_amt::DOUBLE inv_amt, "
   "dlv_qty::DOUBLE dlv_qty, ord_qty::DOUBLE ord_qty, ord_amt_lc::DOUBLE ord_amt_lc, "
   "ord_amt_fc::DOUBLE ord_amt_fc FROM mt")
def b26(c: Ctx):
    return c.rec.matched.select("company", "VKORG", "VBELN", "POSNR", *M.MATCH_MEASURES)


@q("b27_differences", "SELECT VKORG, VBELN, POSNR, amt_diff::DOUBLE amt_diff, od_qty_diff::DOUBLE od_qty_diff, "
   "oi_qty_diff::DOUBLE oi_qty_diff, di_qty_diff::DOUBLE di_qty_diff FROM mt")
def b27(c: Ctx):
    return c.rec.matched.select("VKORG", "VBELN", "POSNR", "amt_diff", "od_qty_diff", "oi_qty_diff", "di_qty_diff")


@q("b28_order_invoice_diff", "SELECT VKORG, VBELN, POSNR, (ord_amt_lc - inv_amt)::DOUBLE order_inv_diff FROM cl")
def b28(c: Ctx):
    return c.an.classified.select("VKORG", "VBELN", "POSNR",
                                  X.order_inv_diff().alias("order_inv_diff"))


@q("b29_negative_invoice", f"SELECT {_MATCH_SQL_COLS} FROM mt WHERE is_negative")
def b29(c: Ctx):
    return c.rec.negative.select(*MATCH_COLS)


@q("b30_unit_ratio_fix", "SELECT company, VKORG, VBELN, POSNR, ord_qty::DOUBLE ord_qty, dlv_qty_raw::DOUBLE dlv_qty_raw, "
   "dlv_qty::DOUBLE dlv_qty FROM cl WHERE unit_fix")
def b30(c: Ctx):
    return c.an.classified.where("unit_fix").select("company", "VKORG", "VBELN", "POSNR", "ord_qty", "dlv_qty_raw",
                                                   "dlv_qty")


@q("b31_scenario", "SELECT company, VKORG, VBELN, POSNR, scenario::BIGINT scenario, unit_fix FROM cl")
def b31(c: Ctx):
    return c.an.classified.select("company", "VKORG", "VBELN", "POSNR", "scenario", "unit_fix")


@q("b33_detail_projection", "SELECT company, VKORG, VBELN, POSNR, scenario::BIGINT scenario, inv_amt::DOUBLE inv_amt, "
   "dlv_qty::DOUBLE dlv_qty FROM cl WHERE scenario NOT IN (0, 10)")
def b33(c: Ctx):
    return c.an.detail.select("company", "VKORG", "VBELN", "POSNR", "scenario", "inv_amt", "dlv_qty")


@q("b34_drop_scenario10", "SELECT company, scenario, rows, inv_amt FROM st WHERE scenario <> 10")
def b34(c: Ctx):
    st, _ = S.drop_scenario10(c.st.stats, c.an.detail)
    return st.select("company", "scenario", "rows", "inv_amt")


@q("b37_posnr_variants", """
SELECT VBELN, POSNR, CASE WHEN try_cast(trim(POSNR) AS BIGINT) IS NULL THEN trim(POSNR)
  ELSE lpad(try_cast(trim(POSNR) AS BIGINT)::VARCHAR, 6, '0') END posnr_norm FROM vbrp""")
def b37(c: Ctx):
    return c.t["VBRP"].select("VBELN", "POSNR", X.posnr_norm("POSNR").alias("posnr_norm"))


@q("b39_company_filter", "SELECT company, scenario, rows FROM st WHERE company IN ('4000', '4010', '4020')")
def b39(c: Ctx):
    wanted = CO.select_companies(c.st.stats, ["4000", "4010", "4020"])
    return c.st.stats.join(wanted, "company", "left_semi").select("company", "scenario", "rows")


# ---------------------------------------------------------------------------
# C: joins
# ---------------------------------------------------------------------------

@q("c1_order_lines", "SELECT VKORG, VBELN, POSNR, MATNR, AUART, ord_qty::DOUBLE ord_qty, "
   "ord_amt_lc::DOUBLE ord_amt_lc FROM ol")
def c1(c: Ctx):
    return c.order_lines.select("VKORG", "VBELN", "POSNR", "MATNR", "AUART", "ord_qty", "ord_amt_lc")


@q("c2_delivery_lines", "SELECT VKORG, VBELN, POSNR, ORD_VBELN, ORD_POSNR, dlv_qty::DOUBLE dlv_qty FROM dl2")
def c2(c: Ctx):
    return c.delivery_lines.select("VKORG", "VBELN", "POSNR", "ORD_VBELN", "ORD_POSNR", "dlv_qty")


@q("c3_invoice_lines", "SELECT VKORG, VBELN, POSNR, ORD_VBELN, ORD_POSNR, FKART, inv_amt::DOUBLE inv_amt, "
   "inv_qty::DOUBLE inv_qty FROM il")
def c3(c: Ctx):
    return c.invoice_lines.select("VKORG", "VBELN", "POSNR", "ORD_VBELN", "ORD_POSNR", "FKART", "inv_amt", "inv_qty")


@q("c4_order_set_filter", "SELECT VBELN, POSNR FROM dc4")
def c4(c: Ctx):
    d = DV._joined(c.t["LIKP"], c.t["LIPS"], dedup=True)
    return DV.order_set_filter(d, c.known).select("VBELN", "POSNR")


@q("c5_order_line_set_filter", "SELECT VBELN, POSNR FROM vbap WHERE VBELN IN (SELECT VBELN FROM vbak)")
def c5(c: Ctx):
    return OR.lines_of_headers(c.t["VBAK"], c.t["VBAP"]).select("VBELN", "POSNR")


@q("c6_invoice_set_filter", f"""
SELECT VBELN, POSNR FROM ij WHERE {O.DT('FKDAT')} BETWEEN DATE '{O._IF}' AND DATE '{O._IL}'
  AND (VBELV IN (SELECT k FROM known) OR AUBEL IN (SELECT k FROM known))""")
def c6(c: Ctx):
    d = IV._period_lines(c.t["VBRK"], c.t["VBRP"], c.p)
    return DV.order_set_filter(d, c.known, ("VBELV", "AUBEL")).select("VBELN", "POSNR")


_OWN_EXCL_SQL = """
, own AS (SELECT code FROM excl UNION SELECT BUKRS_VF FROM vbak WHERE regexp_full_match(BUKRS_VF, '[0-9]{4}')
          UNION SELECT BUKRS FROM vbrk WHERE regexp_full_match(BUKRS, '[0-9]{4}')),
own2 AS (SELECT code FROM own WHERE code <> '4480')
"""


@q("c7_exclude_intercompany", _OWN_EXCL_SQL + f"""
SELECT 'VBAK' AS src, VBELN FROM vbak WHERE {O.ST('KUNNR')} IN (SELECT code FROM own2)
UNION ALL SELECT 'VBRK', VBELN FROM vbrk WHERE {O.ST('KUNAG')} IN (SELECT code FROM own2)""")
def c7(c: Ctx):
    excl = C.exclusion_set(c.spark, c.p.with_(exclude_own_company_codes=True), c.t["VBAK"], c.t["VBRK"])

    def hits(df, col, src):
        kept = C.drop_excluded(df, col, excl).select("VBELN")
        return df.select("VBELN").exceptAll(kept).select(F.lit(src).alias("src"), "VBELN")
    return hits(c.t["VBAK"], "KUNNR", "VBAK").unionByName(hits(c.t["VBRK"], "KUNAG", "VBRK"))


@q("c8_batch_child_dedup", """
SELECT VBELN, POSNR, UEPOS, UECHA FROM dl EXCEPT ALL SELECT VBELN, POSNR, UEPOS, UECHA FROM dl2""")
def c8(c: Ctx):
    before = DV.delivery_lines(c.t["LIKP"], c.t["LIPS"], c.known, c.p, batch_dedup=False)
    after = c.delivery_lines
    cols = ["VBELN", "POSNR", "UEPOS", "UECHA"]
    return before.select(*cols).exceptAll(after.select(*cols))


@q("c9_three_way_match", f"SELECT {_MATCH_SQL_COLS} FROM mt")
def c9(c: Ctx):
    return c.stored.matched.select(*MATCH_COLS)


@q("c10_attach_description", "SELECT VKORG, VBELN, POSNR, MATNR, ARKTX FROM mt")
def c10(c: Ctx):
    return c.rec.matched.select("VKORG", "VBELN", "POSNR", "MATNR", "ARKTX")


@q("c11_attach_order_type", "SELECT VKORG, VBELN, POSNR, AUART FROM mt")
def c11(c: Ctx):
    return c.rec.matched.select("VKORG", "VBELN", "POSNR", "AUART")


@q("c12_attach_doc_numbers", "SELECT VKORG, VBELN, POSNR, inv_docs, inv_type, dlv_docs FROM mt")
def c12(c: Ctx):
    return c.rec.matched.select("VKORG", "VBELN", "POSNR", "inv_docs", "inv_type", "dlv_docs")


UT_COLS = ["company", "VKORG", "VBELN", "POSNR", "MATNR", "AUART", "ord_amt_fc", "ord_amt_lc", "ord_qty", "dlv_qty",
           "dlv_docs", "class"]


@q("c13_untested_outer", "SELECT company, VKORG, VBELN, POSNR, MATNR, AUART, ord_amt_fc::DOUBLE ord_amt_fc, "
   "ord_amt_lc::DOUBLE ord_amt_lc, ord_qty::DOUBLE ord_qty, dlv_qty::DOUBLE dlv_qty, dlv_docs, class FROM ut")
def c13(c: Ctx):
    return c.rec.untested.select(*UT_COLS)


# ---------------------------------------------------------------------------
# D: aggregations
# ---------------------------------------------------------------------------

@q("d1_order_pivot", "SELECT VKORG, VBELN, POSNR, MATNR, ord_amt_fc::DOUBLE ord_amt_fc, ord_amt_lc::DOUBLE ord_amt_lc, "
   "ord_qty::DOUBLE ord_qty, AUART FROM op")
def d1(c: Ctx):
    return c.rec.pivots.order.drop("company")


@q("d2_order_key_agg", "SELECT VKORG, VBELN, POSNR, ord_amt_fc::DOUBLE ord_amt_fc, ord_amt_lc::DOUBLE ord_amt_lc, "
   "ord_qty::DOUBLE ord_qty, MATNR, ARKTX, AUART, n_materials::BIGINT n_materials FROM ok")
def d2(c: Ctx):
    return c.rec.pivots.order_key.drop("company")


@q("d3_delivery_pivot", "SELECT VKORG, VBELN, POSNR, dlv_qty::DOUBLE dlv_qty, dlv_docs FROM dp")
def d3(c: Ctx):
    return c.rec.pivots.delivery.drop("company")


@q("d4_invoice_pivot", "SELECT VKORG, VBELN, POSNR, inv_amt::DOUBLE inv_amt, inv_qty::DOUBLE inv_qty, inv_type, "
   "inv_docs FROM ip")
def d4(c: Ctx):
    return c.rec.pivots.invoice.drop("company")


@q("d5_concat_doc_numbers", "SELECT VKORG, VBELN, POSNR, dlv_docs AS docs, 'delivery' kind FROM dp "
   "UNION ALL SELECT VKORG, VBELN, POSNR, inv_docs, 'invoice' FROM ip")
def d5(c: Ctx):
    a = c.rec.pivots.delivery.select("VKORG", "VBELN", "POSNR", F.col("dlv_docs").alias("docs"),
                                     F.lit("delivery").alias("kind"))
    b = c.rec.pivots.invoice.select("VKORG", "VBELN", "POSNR", F.col("inv_docs").alias("docs"),
                                    F.lit("invoice").alias("kind"))
    return a.unionByName(b)


@q("d6_first_invoice_type", "SELECT VKORG, VBELN, POSNR, inv_type FROM ip")
def d6(c: Ctx):
    return c.rec.pivots.invoice.select("VKORG", "VBELN", "POSNR", "inv_type")


_ST_COLS = "company, scenario, rows, pct_rows, inv_amt, pct_amt, order_inv_diff, reported"


@q("d7_scenario_stats", f"SELECT {_ST_COLS} FROM st")
def d7(c: Ctx):
    return c.st.stats


@q("d8_scenario_stats_partial", f"SELECT {_ST_COLS} FROM st WHERE scenario NOT IN (7, 14)")
def d8(c: Ctx):
    return c.st.stats.where(~F.col("scenario").isin(7, 14))


@q("d9_scenario7_count", "SELECT company, rows, pct_rows FROM st WHERE scenario = 7")
def d9(c: Ctx):
    return c.st.stats.where("scenario = 7").select("company", "rows", "pct_rows")


@q("d10_negative_invoice_stats", "SELECT company, rows, pct_rows, inv_amt, pct_amt FROM st WHERE scenario = 14")
def d10(c: Ctx):
    return c.st.stats.where("scenario = 14").select("company", "rows", "pct_rows", "inv_amt", "pct_amt")


@q("d11_backfill_diff", """
SELECT s.company, s.scenario, s.order_inv_diff stats_diff, coalesce(d.dd, 0.0) detail_diff,
  abs(s.order_inv_diff - coalesce(d.dd, 0.0)) < 0.005 agree
FROM st s LEFT JOIN (SELECT company, scenario, sum(ord_amt_lc - inv_amt)::DOUBLE dd FROM cl
  WHERE scenario NOT IN (0, 10) GROUP BY company, scenario) d USING (company, scenario)
WHERE s.reported AND s.scenario NOT IN (7, 14)""")
def d11(c: Ctx):
    rec = PL.reconcile_figures(c.spark, c.t, c.p)
    an = PL.analyse(None, c.p, matched=written(rec.matched, "match"), untested=rec.untested)  # read by both sides of the check
    return S.backfill_check(an.stats, an.classified)


@q("d12_group_scenarios", """
SELECT 'ALL' company, scenario, sum(rows)::BIGINT rows, sum(inv_amt::DECIMAL(38,2))::DOUBLE inv_amt,
  sum(order_inv_diff::DECIMAL(38,2))::DOUBLE order_inv_diff, bool_or(reported) reported FROM st GROUP BY scenario""")
def d12(c: Ctx):
    return R.group_scenarios(c.st.stats)


def _table_sql(src: str) -> str:
    lines = ", ".join(f"({x}, '{x}')" for x in R.TABLE_LINES)
    return f"""
, tb AS (SELECT company, scenario, rows, inv_amt, order_inv_diff FROM {src}
         UNION ALL SELECT 'ALL', scenario, sum(rows), sum(inv_amt), sum(order_inv_diff) FROM {src} GROUP BY scenario),
tw AS (SELECT company,
   sum(CASE WHEN scenario BETWEEN 1 AND 13 THEN rows ELSE 0 END) sub_n,
   coalesce(sum(CASE WHEN scenario BETWEEN 1 AND 13 THEN inv_amt END), 0) sub_a,
   coalesce(sum(CASE WHEN scenario BETWEEN 1 AND 13 THEN order_inv_diff END), 0) sub_d,
   sum(CASE WHEN scenario = 14 THEN rows ELSE 0 END) neg_n,
   coalesce(sum(CASE WHEN scenario = 14 THEN inv_amt END), 0) neg_a FROM tb GROUP BY company),
tl(sid, line) AS (VALUES {lines})
SELECT b.company, l.line, l.sid::BIGINT line_order, b.rows::BIGINT rows,
  CASE WHEN w.sub_n > 0 AND b.rows <> 0 THEN {O.PCT('b.rows', 'w.sub_n')} ELSE 0.0 END pct_rows,
  b.inv_amt::DOUBLE inv_amt,
  CASE WHEN l.sid = 7 THEN 0.0 WHEN abs(w.sub_a) >= 1e-9 THEN {O.PCT('b.inv_amt', 'w.sub_a')} ELSE NULL END pct_amt,
  b.order_inv_diff::DOUBLE order_inv_diff
FROM tb b JOIN tl l ON b.scenario = l.sid JOIN tw w ON w.company = b.company
UNION ALL SELECT company, 'subtotal', 20, sub_n::BIGINT, CASE WHEN sub_n > 0 THEN 100.0 ELSE 0.0 END, sub_a::DOUBLE,
  CASE WHEN abs(sub_a) >= 1e-9 THEN 100.0 ELSE 0.0 END, sub_d::DOUBLE FROM tw
UNION ALL SELECT company, '14', 21, neg_n::BIGINT, CASE WHEN sub_n > 0 THEN {O.PCT('neg_n', 'sub_n')} ELSE 0.0 END,
  neg_a::DOUBLE, CASE WHEN abs(sub_a + neg_a) >= 1e-9 THEN {O.PCT('neg_a', 'sub_a + neg_a')} ELSE NULL END, NULL FROM tw
UNION ALL SELECT company, 'total', 22, (sub_n + neg_n)::BIGINT, NULL, (sub_a + neg_a)::DOUBLE, NULL, sub_d::DOUBLE FROM tw"""


@q("d13_scenario_table", _table_sql("sb"))
def d13(c: Ctx):
    return R.scenario_table(c.st.stats, "reported")


@q("d14_four_classes", f"""
SELECT company, {O._classes_sql('sb')} class, sum(rows)::BIGINT rows, sum(inv_amt)::DOUBLE inv_amt FROM sb
WHERE {O._classes_sql('sb')} IS NOT NULL GROUP BY company, class""")
def d14(c: Ctx):
    return R.four_classes(c.st.stats, "reported")


_TIER_P = fixture_params().with_(tier_high=20.0, tier_mid=15.0)


def _rates_select(src: str, high: float, mid: float) -> str:
    return f"""SELECT company, mr::BIGINT match_rows, tr::BIGINT total_rows,
  CASE WHEN tr > 0 THEN {O.PCT('mr', 'tr')} ELSE 0.0 END pct_rows, ma::DOUBLE match_amt, ta::DOUBLE total_amt,
  CASE WHEN ta > 0 THEN {O.PCT('ma', 'ta')} ELSE 0.0 END pct_amt, {O.tier_sql(high, mid)} tier,
  CASE WHEN {O.tier_sql(high, mid)} = 'low' THEN 'amount match rate < {mid:g}%' ELSE '' END remark,
  na::DOUBLE neg_amt FROM {O.rates_sql(src, high, mid)}"""


@q("d15_company_match_rate", _rates_select("sbf", 20.0, 15.0))
def d15(c: Ctx):
    return R.company_match_rate(c.st.stats, _TIER_P, "full").drop("_raw_pct_amt")


@q("d15_company_match_rate_reported", _rates_select("sb", 80.0, 60.0))
def d15r(c: Ctx):
    return R.company_match_rate(c.st.stats, c.p, "reported").drop("_raw_pct_amt")


def _summary_sql(where: str = "") -> str:
    return (f"count(*) {where}::BIGINT companies, coalesce(sum(mr) {where}, 0)::BIGINT match_rows, "
            f"coalesce(sum(tr) {where}, 0)::BIGINT total_rows, "
            f"coalesce(sum(ma) {where}, 0) _ma, coalesce(sum(ta) {where}, 0) _ta")


def _finish_sql(keys: str, src: str) -> str:
    return f"""SELECT {keys}, companies, match_rows, total_rows,
  CASE WHEN total_rows > 0 THEN {O.PCT('match_rows', 'total_rows')} END pct_rows,
  _ma::DOUBLE match_amt, _ta::DOUBLE total_amt, CASE WHEN _ta > 0 THEN {O.PCT('_ma', '_ta')} END pct_amt FROM {src}"""


@q("d16_tier_summary", f"""
, rt AS (SELECT *, {O.tier_sql(20.0, 15.0)} tier FROM {O.rates_sql('sbf', 20.0, 15.0)}),
td(tier, tier_order) AS (VALUES ('high', 1), ('mid', 2), ('low', 3)),
ta AS (SELECT td.tier, td.tier_order, count(rt.company) companies, coalesce(sum(mr), 0)::BIGINT match_rows,
   coalesce(sum(tr), 0)::BIGINT total_rows, coalesce(sum(ma), 0) _ma, coalesce(sum(ta), 0) _ta
   FROM td LEFT JOIN rt USING (tier) GROUP BY td.tier, td.tier_order)
{_finish_sql('tier, tier_order::BIGINT tier_order', 'ta')}""")
def d16(c: Ctx):
    rates = R.company_match_rate(c.st.stats, _TIER_P, "full")
    return R.tier_summary(c.spark, rates)


@q("d17_overall_match", f"""
, ov AS (SELECT 'all' scope, count(*) companies, coalesce(sum(mr), 0)::BIGINT match_rows,
   coalesce(sum(tr), 0)::BIGINT total_rows, coalesce(sum(ma), 0) _ma, coalesce(sum(ta), 0) _ta
   FROM {O.rates_sql('sbf', 20.0, 15.0)})
{_finish_sql('scope', 'ov')}""")
def d17(c: Ctx):
    return R.overall_match(R.company_match_rate(c.st.stats, _TIER_P, "full"))


@q("d18_sensitivity", f"""
, rt AS (SELECT * FROM {O.rates_sql('sbf', 20.0, 15.0)}),
sv AS (SELECT '>=20%' scope, count(*) FILTER (WHERE raw_pa >= 20.0) companies,
   coalesce(sum(mr) FILTER (WHERE raw_pa >= 20.0), 0)::BIGINT match_rows,
   coalesce(sum(tr) FILTER (WHERE raw_pa >= 20.0), 0)::BIGINT total_rows,
   coalesce(sum(ma) FILTER (WHERE raw_pa >= 20.0), 0) _ma, coalesce(sum(ta) FILTER (WHERE raw_pa >= 20.0), 0) _ta,
   coalesce(string_agg(company, ', ' ORDER BY company) FILTER (WHERE raw_pa < 20.0), '') removed_companies FROM rt)
SELECT scope, companies, match_rows, total_rows,
  CASE WHEN total_rows > 0 THEN {O.PCT('match_rows', 'total_rows')} END pct_rows,
  _ma::DOUBLE match_amt, _ta::DOUBLE total_amt, CASE WHEN _ta > 0 THEN {O.PCT('_ma', '_ta')} END pct_amt,
  removed_companies FROM sv""")
def d18(c: Ctx):
    return R.sensitivity(R.company_match_rate(c.st.stats, _TIER_P, "full"), _TIER_P)


@q("d18_removed_companies", f"""SELECT company, CASE WHEN ta > 0 THEN {O.PCT('ma', 'ta')} ELSE 0.0 END pct_amt
FROM {O.rates_sql('sbf', 20.0, 15.0)} WHERE raw_pa < 20.0""")
def d18r(c: Ctx):
    return R.removed_companies(R.company_match_rate(c.st.stats, _TIER_P, "full"), _TIER_P)


@q("d19_internal_only_flag", """
SELECT company, sum(CASE WHEN scenario BETWEEN 1 AND 13 THEN rows ELSE 0 END) = 0 internal_only FROM sb GROUP BY company""")
def d19(c: Ctx):
    return R.internal_only(c.st.stats)


@q("d20_untested_summary", """
, us AS (SELECT company, sum(CASE WHEN class = 'order_only' THEN 1 ELSE 0 END) oo_n,
   sum(CASE WHEN class = 'order_only' THEN ord_amt_lc END) oo_a,
   sum(CASE WHEN class = 'order_delivery' THEN 1 ELSE 0 END) od_n,
   sum(CASE WHEN class = 'order_delivery' THEN ord_amt_lc END) od_a
   FROM ut WHERE class IN ('order_only', 'order_delivery') AND VBELN IN (SELECT VBELN FROM vo) GROUP BY company),
uc AS (SELECT DISTINCT company FROM ut),
up AS (SELECT uc.company, coalesce(oo_n, 0) oo_n, coalesce(oo_a, 0) oo_a, coalesce(od_n, 0) od_n,
   coalesce(od_a, 0) od_a FROM uc LEFT JOIN us USING (company)),
ur AS (SELECT company, oo_n, oo_a, od_n, od_a FROM up
   UNION ALL SELECT 'TOTAL', sum(oo_n), sum(oo_a), sum(od_n), sum(od_a) FROM up)
SELECT company, oo_n::BIGINT order_only_rows, oo_a::DECIMAL(38,2)::DOUBLE order_only_amt,
  od_n::BIGINT order_delivery_rows, od_a::DECIMAL(38,2)::DOUBLE order_delivery_amt, (oo_n + od_n)::BIGINT total_rows,
  (oo_a + od_a)::DECIMAL(38,2)::DOUBLE total_amt FROM ur""")
def d20(c: Ctx):
    return R.untested_summary(c.rec.untested, c.t["VBAK"], c.excl, c.p)


@q("d21_legacy_scenarios", """
, lg AS (SELECT company, inv_amt, abs(ord_qty - inv_qty) < 0.01 oi, abs(ord_qty - dlv_qty) < 0.01 od,
   abs(dlv_qty - inv_qty) < 0.01 di, delivery_missing miss, amt_diff < -0.01 lt, amt_diff > 0.01 gt
   FROM mt WHERE NOT is_negative),
lx AS (SELECT company, inv_amt, unnest([
   CASE WHEN oi AND (miss OR NOT di) AND lt THEN 1 END, CASE WHEN oi AND (miss OR NOT di) AND gt THEN 2 END,
   CASE WHEN oi AND (miss OR NOT di) AND NOT (lt OR gt) THEN 3 END,
   CASE WHEN NOT oi AND lt THEN 4 END, CASE WHEN NOT oi AND gt THEN 5 END, CASE WHEN NOT oi AND NOT (lt OR gt) THEN 6 END,
   CASE WHEN oi AND NOT miss AND di AND lt THEN 8 END, CASE WHEN oi AND NOT miss AND di AND gt THEN 9 END,
   CASE WHEN oi AND NOT miss AND di AND NOT (lt OR gt) THEN 10 END,
   CASE WHEN NOT miss AND od AND NOT oi AND NOT (lt OR gt) THEN 11 END,
   CASE WHEN NOT miss AND od AND NOT oi AND lt THEN 12 END, CASE WHEN NOT miss AND od AND NOT oi AND gt THEN 13 END
   ]) scenario FROM lg)
SELECT company, scenario::BIGINT scenario, count(*)::BIGINT rows, sum(inv_amt)::DOUBLE inv_amt FROM lx
WHERE scenario IS NOT NULL GROUP BY company, scenario""")
def d21(c: Ctx):
    return S.legacy_scenarios(c.rec.main, c.p)


@q("d22_missing_invoice_amount", """
SELECT company, count(*)::BIGINT rows, sum(ord_amt_lc)::DECIMAL(38,2)::DOUBLE order_amt FROM ut
WHERE class IN ('order_only', 'order_delivery') GROUP BY company""")
def d22(c: Ctx):
    return R.missing_invoice_amount(c.rec.untested)


@q("d24_control_totals", """
SELECT (SELECT count(*) FROM mt)::BIGINT rows_out, (SELECT count(*) FROM ip)::BIGINT invoice_keys,
  ((SELECT count(*) FROM mt) - (SELECT count(*) FROM ip))::BIGINT fan_out,
  (SELECT count(*) FROM mt WHERE is_negative)::BIGINT negative_rows,
  (SELECT sum(inv_amt) FROM ip)::DOUBLE invoice_total,
  (SELECT count(*) FROM ok WHERE n_materials > 1)::BIGINT multi_material_keys""")
def d24(c: Ctx):
    return c.rec.control()


# ---------------------------------------------------------------------------
# F: distinct / keep-first;  G: set operations
# ---------------------------------------------------------------------------

@q("f1_dedupe_delivery_header", "SELECT MANDT, VBELN, VKORG, LFART FROM likp1")
def f1(c: Ctx):
    return C.keep_first(c.t["LIKP"], ["MANDT", "VBELN"]).select("MANDT", "VBELN", "VKORG", "LFART")


@q("f2_dedupe_delivery_line", "SELECT MANDT, VBELN, POSNR, VBELV, VGBEL, LFIMG::DOUBLE LFIMG FROM lips1")
def f2(c: Ctx):
    return C.keep_first(c.t["LIPS"], ["MANDT", "VBELN", "POSNR"]).select("MANDT", "VBELN", "POSNR", "VBELV", "VGBEL",
                                                                        "LFIMG")


@q("f3_dedupe_order_header", "SELECT VBELN FROM vo")
def f3(c: Ctx):
    return R.valid_orders(c.t["VBAK"], c.excl, c.p)


@q("f4_material_mapper", "SELECT MATNR, VKORG, VBELN, POSNR, ARKTX FROM mm")
def f4(c: Ctx):
    return OR.material_mapper(c.order_lines).drop("company")


@q("g1_exclusion_set", _OWN_EXCL_SQL + "SELECT code FROM own2")
def g1(c: Ctx):
    """The default: the fixed list and the company codes in the data."""
    return C.exclusion_set(c.spark, c.p.with_(exclude_own_company_codes=True), c.t["VBAK"], c.t["VBRK"])


# ---------------------------------------------------------------------------
# lists (B22–B25)
# ---------------------------------------------------------------------------

def _null(*names: str, kind: str = "VARCHAR") -> str:
    """Columns that no fixture table has."""
    return ", ".join(f"NULL::{kind} {n}" for n in names)


_DAY = "strftime({}, '%Y-%m-%d')"


@q("b22_order_list", f"""SELECT l.VKORG sales_org, l.VBELN order_no, POSNR order_item, l.AUART order_type, MATNR material, ARKTX material_text,
  l.KUNNR sold_to, {_null('sales_group', 'sales_office', 'created_on', 'base_unit', 'sales_unit', 'plant', 'storage_loc', 'shipping_point')},
  {_DAY.format('order_date')} order_date, {_DAY.format(O.DT('h.AUDAT'))} doc_date, KWMENG::DOUBLE qty_sales_unit, KLMENG::DOUBLE qty_base_unit,
  l.NETWR::DOUBLE net_value, NULL::DOUBLE net_price, ord_qty::DOUBLE qty_calc, ord_amt_fc::DOUBLE amount_fc_calc, ord_amt_lc::DOUBLE amount_lc_calc,
  h.WAERK currency, WKURS::DOUBLE exchange_rate FROM ol l JOIN vbak h ON l.VBELN = h.VBELN""")
def b22(c: Ctx):
    return PL.build_lists(c.spark, c.t, c.p, deliveries=False, invoices=False)["order_list"]


def _dlv_list(dedup: str) -> str:
    return f"""SELECT VKORG sales_org, VBELN delivery_no, POSNR delivery_item, coalesce(LFART,'') delivery_type, UEPOS batch_parent_item, UECHA batch_parent_split,
  CASE WHEN {O.B('VBELV')} THEN VGBEL ELSE VBELV END order_no, CASE WHEN {O.B('POSNV')} THEN VGPOS ELSE POSNV END order_item,
  {_null('material', 'material_text', 'customer', 'base_unit', 'sales_unit', 'plant', 'storage_loc', 'created_on', 'delivery_date', 'batch')},
  LFIMG::DOUBLE qty_sales_unit, LGMNG::DOUBLE qty_base_unit, '' qty_unit, (coalesce(LFIMG,0) * {O.SG('SHKZG')})::DOUBLE qty_calc, SHKZG dc_flag FROM {dedup}"""


@q("b23_delivery_list", _dlv_list("dc4 WHERE abs(coalesce(LFIMG,0)) >= 0.000001"))
def b23(c: Ctx):
    return PL.build_lists(c.spark, c.t, c.p, orders=False, invoices=False)["delivery_list"]


@q("b24_delivery_list_full", _dlv_list("lips l LEFT JOIN (SELECT MANDT, VBELN, VKORG, LFART FROM likp) h USING (MANDT, VBELN)"))
def b24(c: Ctx):
    return PL.build_lists(c.spark, c.t, c.p, orders=False, invoices=False, delivery_full=True)["delivery_list"]


@q("b25_invoice_list", f"""SELECT VKORG sales_org, VBELN invoice_no, POSNR invoice_item,
  CASE WHEN {O.B('VBELV')} THEN AUBEL ELSE VBELV END order_no, CASE WHEN {O.B('POSNV')} THEN AUPOS ELSE POSNV END order_item,
  {_null('material', 'material_text', 'payer', 'customer', 'sales_unit', 'currency', 'created_on')}, KUNAG sold_to, BUKRS company_code,
  FKART invoice_type, FKIMG::DOUBLE qty_sales_unit, NETWR::DOUBLE net_value, NULL::DOUBLE stat_amount, NULL::DOUBLE tax_amount,
  (coalesce(FKIMG,0) * {O.SG('SHKZG')})::DOUBLE qty_calc, (coalesce(NETWR,0) * {O.SG('SHKZG')})::DOUBLE amount_lc_calc, SHKZG dc_flag,
  {_DAY.format(O.DT('FKDAT'))} billing_date FROM ij
  WHERE {O.DT('FKDAT')} BETWEEN DATE '{O._IF}' AND DATE '{O._IL}' AND {O.ST('KUNAG')} NOT IN (SELECT code FROM excl)
    AND (abs(coalesce(FKIMG,0)) >= 0.000001 OR abs(coalesce(NETWR,0)) >= 0.000001)""")
def b25(c: Ctx):
    return PL.build_lists(c.spark, c.t, c.p, orders=False, deliveries=False)["invoice_list"]


# ---------------------------------------------------------------------------
# verify (C14, D23)
# ---------------------------------------------------------------------------

def _pn(x: str) -> str:
    return (f"(CASE WHEN try_cast(trim({x}) AS BIGINT) IS NULL THEN trim({x}) "
            f"ELSE lpad(try_cast(trim({x}) AS BIGINT)::VARCHAR, 6, '0') END)")


def _verify_sql(keys: str, vbap: str = "vbap") -> str:
    return f"""
, vk AS ({keys}),
vs AS (SELECT trim(VBELN) v, {_pn('POSNR')} p, sum(coalesce(KLMENG, 0)) ks,
         arg_min_null(KLMENG, {{'a': VBELN, 'b': POSNR, 'c': MATNR, 'd': ARKTX, 'e': KWMENG, 'f': NETWR}}) kf
       FROM {vbap} GROUP BY 1, 2),
dr AS (SELECT trim(VBELN) dv, {_pn('POSNR')} dp,
         trim(CASE WHEN {O.B('VGBEL')} THEN VBELV ELSE VGBEL END) ov,
         {_pn(f"CASE WHEN {O.B('VGPOS')} THEN POSNV ELSE VGPOS END")} op
       FROM lips QUALIFY row_number() OVER (PARTITION BY trim(VBELN), {_pn('POSNR')} ORDER BY s, pk, q, x) = 1),
vi AS (SELECT k, bool_and(a = '') OR bool_and(a = '0') blank FROM (SELECT unnest([trim(VBELV), trim(AUBEL)]) k, trim(coalesce(AUBEL, '')) a FROM vbrp) GROUP BY k),
vr AS (SELECT k.VKORG, k.VBELN, k.POSNR, a.ks, d.ov, d.op, b.kf ord_klmeng, coalesce(vi.blank, false) aubel_blank
       FROM vk k LEFT JOIN vi ON vi.k = k.VBELN LEFT JOIN vs a ON k.VBELN = a.v AND {_pn('k.POSNR')} = a.p
       LEFT JOIN dr d ON k.VBELN = d.dv AND {_pn('k.POSNR')} = d.dp
       LEFT JOIN vs b ON d.ov = b.v AND d.op = b.p),
vv AS (SELECT VKORG, VBELN, POSNR, ks::DOUBLE klmeng_sum, ov ord_vbeln, op ord_posnr, ord_klmeng::DOUBLE ord_klmeng, aubel_blank,
       CASE WHEN ks IS NOT NULL AND abs(ks) >= 0.000001 THEN 'order_qty_nonzero'
            WHEN ks IS NOT NULL THEN 'order_qty_zero'
            WHEN ord_klmeng IS NOT NULL AND abs(ord_klmeng) >= 0.000001 THEN 'delivery_no_order_qty_nonzero'
            ELSE 'not_found_or_zero' END verdict FROM vr)
"""


_VERIFY_SQL = _verify_sql("SELECT DISTINCT VKORG, VBELN, POSNR FROM cl WHERE scenario IN (4, 5) AND abs(ord_qty) < 0.01")


@q("c14_verify_lookup", _VERIFY_SQL + "SELECT * FROM vv")
def c14(c: Ctx):
    return V.verify_lookup(PL.analyse(c.stored, c.p).detail, c.t, c.p)


# Keys of every verdict: all order lines (a third of them with quantity zero), all delivery
# lines and all invoice numbers.
_ZEROED = "(SELECT * REPLACE (CASE WHEN POSNR::BIGINT % 30 = 0 THEN 0 ELSE KLMENG END AS KLMENG) FROM vbap)"
_ALL_KEYS = _verify_sql("SELECT DISTINCT '' VKORG, VBELN, POSNR FROM (SELECT VBELN, POSNR FROM vbap UNION ALL SELECT VBELN, POSNR FROM lips "
                        "UNION ALL SELECT VBELN, POSNR FROM vbrp)", _ZEROED)


def verified(c: Ctx) -> DataFrame:
    zero = F.when(F.col("POSNR").cast("bigint") % 30 == 0, F.lit(0)).otherwise(F.col("KLMENG")).cast(c.t["VBAP"].schema["KLMENG"].dataType)
    t = {**c.t, "VBAP": c.t["VBAP"].withColumn("KLMENG", zero)}
    keys = S.union_all([c.t[n].select(F.lit("").alias("VKORG"), "VBELN", "POSNR") for n in ("VBAP", "LIPS", "VBRP")]).distinct()
    return V.verify_lookup(None, t, c.p, keys=keys)


@q("c14_verify_all_keys", _ALL_KEYS + "SELECT * FROM vv")
def c14_all(c: Ctx):
    return verified(c)


@q("d23_verify_all_keys", _ALL_KEYS + "SELECT verdict, count(*) AS rows FROM vv GROUP BY verdict")
def d23_all(c: Ctx):
    return V.verify_summary(verified(c))


@q("d23_verify_summary", _VERIFY_SQL + "SELECT verdict, count(*) AS rows FROM vv GROUP BY verdict")
def d23(c: Ctx):
    return V.verify_summary(V.verify_lookup(PL.analyse(c.stored, c.p).detail, c.t, c.p))


# ---------------------------------------------------------------------------
# labels, what-if, report text, cleanup, sample, order, extract (B32, B35,
# B36, B38, F5, F6, A16, A1)
# ---------------------------------------------------------------------------

def _table_cte(src: str, name: str) -> str:
    """The D13 oracle statement turned into one more CTE ``name``."""
    frag = _table_sql(src)
    i = frag.index("\nSELECT b.company")
    return frag[:i] + f", {name} AS (" + frag[i:] + ")\n"


def _labels_values() -> str:
    rows = [(0, "", "amount difference exactly at tolerance")] + [tuple(r) for r in SCENARIO_LABELS]
    return ", ".join(f"({i}, '{a}', '{b}')" for i, a, b in rows)


@q("b32_scenario_desc", f"""
, lb(scenario, label, label_en) AS (VALUES {_labels_values()})
SELECT s.company, s.scenario, l.label, l.label_en, s.rows FROM st s LEFT JOIN lb l ON s.scenario = l.scenario""")
def b32(c: Ctx):
    labels = S.scenario_labels(c.spark)
    return c.st.stats.join(F.broadcast(labels), "scenario", "left").select(
        "company", "scenario", "label", "label_en", "rows")


@q("b35_scale_scenario_diff", _table_cte("sb", "tbl") + """
SELECT company, line, order_inv_diff,
  CASE WHEN line = '5' THEN 0.1 ELSE 1.0 END::DOUBLE factor,
  CASE WHEN line = '5' THEN order_inv_diff * 0.1::DOUBLE
       WHEN line IN ('subtotal', 'total') THEN order_inv_diff + sum(coalesce(
         CASE WHEN line = '5' THEN order_inv_diff * (0.1::DOUBLE - 1.0::DOUBLE) END, 0.0)) OVER (PARTITION BY company)
       ELSE order_inv_diff END diff_adjusted
FROM tbl""")
def b35(c: Ctx):
    t = R.scenario_table(c.st.stats, "reported")
    return S.scale_scenario_diff(t, 5, 0.1).select("company", "line", "order_inv_diff", "factor", "diff_adjusted")


def _amt_text_sql(x: str, digits: int) -> str:
    fmt = "{:,.%df}" % digits
    return (f"(CASE WHEN {x} IS NULL THEN '' WHEN {x} = 0 THEN '-' "
            f"WHEN {x} < 0 THEN '(' || format('{fmt}', (-{x})::DOUBLE) || ')' "
            f"ELSE format('{fmt}', ({x})::DOUBLE) END)")


def _pct_text_sql(x: str, missing: str = "") -> str:
    return f"(CASE WHEN {x} IS NULL THEN '{missing}' ELSE format('{{:,.2f}}', ({x})::DOUBLE) || '%' END)"


@q("b36_report_numbers", _table_cte("sb", "tbl") + f"""
, fx AS (SELECT company, line, line_order,
   round_even(rows::DECIMAL(38,6), 0) r0, round_even(pct_rows::DECIMAL(38,6), 2) pr,
   round_even(inv_amt::DECIMAL(38,6), 2) ia, round_even(pct_amt::DECIMAL(38,6), 2) pa,
   round_even(order_inv_diff::DECIMAL(38,6), 2) od FROM tbl)
SELECT company, line, line_order, {_amt_text_sql('r0', 0)} rows_text, {_pct_text_sql('pr')} pct_rows_text,
  {_amt_text_sql('ia', 2)} inv_amt_text, CASE WHEN line = 'total' THEN '' ELSE {_pct_text_sql('pa', 'N/A')} END pct_amt_text,
  CASE WHEN line = '14' THEN '-' ELSE {_amt_text_sql('od', 2)} END diff_text,
  coalesce(ia, 0)::DOUBLE inv_amt_back
FROM fx""")
def b36(c: Ctx):
    return R.display_table(R.scenario_table(c.st.stats, "reported"))


@q("b38_material_cleanup", "SELECT VKORG, VBELN, POSNR, "
   "regexp_replace(regexp_replace(MATNR, '​', '', 'g'), '\\.0+$', '') MATNR FROM cl WHERE scenario NOT IN (0, 10)")
def b38(c: Ctx):
    return c.an.detail.select("VKORG", "VBELN", "POSNR", X.material_cleanup("MATNR").alias("MATNR"))


@q("f5_sample_keys", """
SELECT VKORG, VBELN, POSNR FROM (SELECT DISTINCT VKORG, VBELN, POSNR FROM cl WHERE scenario NOT IN (0, 10))
ORDER BY ((coalesce(TRY_CAST(VBELN AS BIGINT), 0) % 2147483647) * 48271
        + (coalesce(TRY_CAST(POSNR AS BIGINT), 0) % 2147483647) * 16807 + 42) % 2147483647, VKORG, VBELN, POSNR
LIMIT 500""")
def f5(c: Ctx):
    keys = c.an.detail.select("VKORG", "VBELN", "POSNR").distinct()
    return V.sample_keys(keys, 500, 42)


@q("f6_ordered_output", _table_cte("sb", "tbl") + """
SELECT row_number() OVER (ORDER BY company, line_order) position, company, line FROM tbl""")
def f6(c: Ctx):
    return R.ordered_report(R.scenario_table(c.st.stats, "reported")).select("position", "company", "line")


@q("a16_scenario_extract", "SELECT company, scenario, VKORG, VBELN, POSNR, inv_amt::DOUBLE inv_amt "
   "FROM cl WHERE scenario NOT IN (0, 10)")
def a16(c: Ctx):
    return PL.scenario_extract(c.an.classified).select("company", "scenario", "VKORG", "VBELN", "POSNR", "inv_amt")


@q("a1_scan_extract", f"""SELECT MANDT, VBELN, VKORG, strftime({O.DT('AUDAT')}, '%Y-%m-%d') AUDAT, NULL::VARCHAR ERDAT,
  AUART, KUNNR, NULL::VARCHAR VKGRP, NULL::VARCHAR VKBUR, NETWR::DOUBLE NETWR, WAERK, BUKRS_VF FROM vbak""")
def a1(c: Ctx):
    # round trip: the order headers written as a '#|#' text extract under the
    # shared checkpoint folder, then read back by the extract source
    path = stage_dir(c.spark, f"a1-extract-{uuid.uuid4().hex}")
    write_extract(c.t["VBAK"], path)
    parts = EX.list_files(c.spark, f"{path}/part-*")
    return EX.read_extract(c.spark, parts, "VBAK").df.drop("_ord")


def _load() -> None:
    from . import roundtrips, variants  # noqa: F401  register their queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, _f=fn: export(_f(Ctx(spark, sf_dir)))) for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
