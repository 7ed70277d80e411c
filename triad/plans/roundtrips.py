"""Registered queries for sources, sinks and whole runs: each writes what it
reads (derived from the given tables) under the shared checkpoint folder and
reads it back with the engine, so that its work grows with the tables.

Also the match by company code, on a variant of the fixture in which a sales
organisation has two companies.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import oracle as O
from ..config import fixture_params
from ..operators import invoices as IV
from ..operators import matching as M
from ..operators import report as R
from ..operators import scenarios as S
from ..session import stage_dir
from ..sources import extract as EX
from ..sources.fixtures import fixture_tables, two_company_views
from ..streaming.ingest import ingest_stream, read_settled, settle
from . import pipeline as PL
from . import stages as ST
from .catalog import _HDR_SQL, _MATCH_SQL_COLS, _ST_COLS, MATCH_COLS, REGISTRY, UT_COLS, Ctx, _rates_select, q


def scratch(c: Ctx, name: str) -> str:
    return stage_dir(c.spark, f"{name}-{uuid.uuid4().hex}")


def put_parts(c: Ctx, df: DataFrame, folder: str, prefix: str, first: int = 1) -> None:
    """``df`` as text parts ``<prefix>_<n>.TXT`` of ``folder``."""
    raw = f"{folder}/raw-{uuid.uuid4().hex}"
    EX.write_extract(df, raw)
    jvm = c.spark._jvm
    for i, path in enumerate(EX.list_files(c.spark, f"{raw}/part-*"), first):
        src = jvm.org.apache.hadoop.fs.Path(path)
        fs = src.getFileSystem(c.spark._jsc.hadoopConfiguration())
        fs.rename(src, jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}_{i}.TXT"))


VBAK = ["MANDT", "VBELN", "VKORG", "AUDAT", "NETWR", "BUKRS_VF"]


def vbak(c: Ctx) -> DataFrame:
    return c.t["VBAK"].select(*VBAK)


_VBAK_SQL = f"SELECT VBELN, VKORG, strftime({O.DT('AUDAT')}, '%Y-%m-%d') AUDAT, NETWR::DOUBLE NETWR FROM vbak"


def back(c: Ctx, folder: str) -> DataFrame:
    return EX.read_table(c.spark, folder, "VBAK").df.select("VBELN", "VKORG", "AUDAT", "NETWR")


@q("a2_normalise_header", _VBAK_SQL)
def a2(c: Ctx):
    d = scratch(c, "a2")
    put_parts(c, vbak(c).toDF(*[f" {x.lower()} " for x in VBAK]), d, "VBAK")
    return back(c, d)


@q("a3_type_policy", f"""SELECT VBELN, POSNR, NETWR::DOUBLE NETWR, FKIMG::DOUBLE FKIMG, FKLMG::DOUBLE FKLMG,
  strftime({O.DT('FKDAT')}, '%Y-%m-%d') FKDAT, 0.0::DOUBLE MWSBP FROM vbrp""")
def a3(c: Ctx):
    d = scratch(c, "a3")
    put_parts(c, c.t["VBRP"].select("MANDT", "VBELN", "POSNR", "NETWR", "FKIMG", "FKLMG", "FKDAT", F.lit("n/a").alias("MWSBP")), d, "VBRP")
    return EX.read_table(c.spark, d, "VBRP").df.select("VBELN", "POSNR", "NETWR", "FKIMG", "FKLMG", "FKDAT", "MWSBP")


@q("a4_trim_strings", _VBAK_SQL)
def a4(c: Ctx):
    d = scratch(c, "a4")
    padded = [F.concat(F.lit("  "), x, F.lit(" ")).alias(x) if x in ("VBELN", "VKORG") else F.col(x) for x in VBAK]
    put_parts(c, vbak(c).select(*padded), d, "VBAK")
    return back(c, d)


@q("a5_malformed_rows", """
SELECT CASE WHEN VBELN::BIGINT % 10 = 0 THEN 'dropped' ELSE 'kept' END what, count(*)::BIGINT n FROM vbak GROUP BY 1""")
def a5(c: Ctx):
    d = scratch(c, "a5")
    extra = F.when(F.col("VBELN").cast("bigint") % 10 == 0, F.concat("BUKRS_VF", F.lit("#|#one more"))).otherwise(F.col("BUKRS_VF"))
    put_parts(c, vbak(c).withColumn("BUKRS_VF", extra), d, "VBAK")
    r = EX.read_table(c.spark, d, "VBAK")
    kept = r.df.select(F.lit("kept").alias("what"))
    return kept.unionByName(r.dropped.select(F.lit("dropped").alias("what"))).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


def two_layouts(c: Ctx, d: str) -> None:
    odd = F.col("VBELN").cast("bigint") % 2 == 1
    put_parts(c, vbak(c).where(odd), d, "VBAK")
    put_parts(c, vbak(c).where(~odd).select(*VBAK[::-1]), d, "VBAK", 1001)


@q("a6_union_parts", _VBAK_SQL)
def a6(c: Ctx):
    d = scratch(c, "a6")
    two_layouts(c, d)
    return back(c, d)


@q("a7_table_globs", _VBAK_SQL)
def a7(c: Ctx):
    d = scratch(c, "a7")
    put_parts(c, vbak(c), d, "VBAK")
    for helper in ("VBAK_VBRP", "XVBAK"):
        put_parts(c, vbak(c), d, helper)
    return back(c, d)


@q("a8_column_whitelist", _VBAK_SQL)
def a8(c: Ctx):
    d = scratch(c, "a8")
    put_parts(c, vbak(c).withColumn("bad-name", F.lit("x")).withColumn("1ST", F.lit("y")), d, "VBAK")
    got = EX.read_table(c.spark, d, "VBAK").df
    if {"bad-name", "1ST"} & set(got.columns):
        raise AssertionError("a column outside the whitelist was kept")
    return got.select("VBELN", "VKORG", "AUDAT", "NETWR")


@q("a13_append_mode", "SELECT company, 2 * rows AS rows FROM (SELECT VKORG company, count(*)::BIGINT rows FROM vbak GROUP BY VKORG)")
def a13(c: Ctx):
    d, df = scratch(c, "a13"), vbak(c).withColumnRenamed("VKORG", "company")
    PL.write_stage(df, d, c.p)
    PL.write_stage(df, d, c.p, append=True)
    return PL.read_stage(c.spark, d).groupBy("company").agg(F.count(F.lit(1)).alias("rows"))


@q("a15_capped_files", "SELECT VKORG company, count(*)::BIGINT rows, true capped FROM vbak GROUP BY VKORG")
def a15(c: Ctx):
    d = scratch(c, "a15")
    PL.write_stage(vbak(c).withColumnRenamed("VKORG", "company"), d, c.p.with_(rows_per_file=50))
    n = PL.read_stage(c.spark, d).groupBy("company", F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("company").agg(F.sum("n").alias("rows"), (F.max("n") <= 50).alias("capped"))


@q("a17_read_back", """SELECT VKORG company, VBELN, '10' batch FROM vbak WHERE VKORG >= '4100'
  UNION ALL SELECT VKORG, VBELN, '9' FROM vbak""")
def a17(c: Ctx):
    """Batch 9, then batch 10 with fewer rows and an empty stage; a third run that is not published."""
    d, df = scratch(c, "a17"), vbak(c).withColumnRenamed("VKORG", "company")
    nine, ten, stopped = (ST.StageRun(c.spark, d, c.p, b) for b in ("9", "10", "11"))
    nine.put("orders", df)
    nine.publish()
    ten.put("orders", df.where("company >= '4100'"))
    ten.put("none", df.where("false"))
    ten.publish()
    stopped.put("orders", df.where("company < '4100'"))
    last = ST.open_run(c.spark, d, c.p)
    if not last.get("none").isEmpty():
        raise AssertionError("an empty stage has rows")
    got = [r.get("orders").select("company", "VBELN", F.lit(r.batch_id).alias("batch")) for r in (last, ST.open_run(c.spark, d, c.p, "9"))]
    return S.union_all(got)


_SPLIT_SQL = f"""
, hc AS ({_HDR_SQL}), hm AS (SELECT DISTINCT "table", VBELN, company FROM hc WHERE company NOT IN ('UNKNOWN', 'UNMAPPED'))
SELECT "table", company, VBELN, '' POSNR FROM hc WHERE company NOT IN ('UNKNOWN', 'UNMAPPED')
UNION ALL SELECT l."table", hm.company, l.VBELN, l.POSNR FROM (SELECT 'VBAP' AS "table", 'VBAK' AS ht, VBELN, POSNR FROM vbap
  UNION ALL SELECT 'LIPS', 'LIKP', VBELN, POSNR FROM lips UNION ALL SELECT 'VBRP', 'VBRK', VBELN, POSNR FROM vbrp) l
  JOIN hm ON hm."table" = l.ht AND hm.VBELN = l.VBELN"""


@q("a10_split_written", _SPLIT_SQL)
def a10_written(c: Ctx):
    """The six tables written by company code and read back."""
    p = c.p.with_(company_by="bukrs")
    run = ST.StageRun(c.spark, scratch(c, "a10"), p)
    counts = {(r["table"], r["status"]): r["rows"] for r in PL.write_split(run, c.t, p).collect()}
    run.publish()
    got = []
    for n in PL.TABLES:
        df = ST.open_run(c.spark, run.folder, p).get(f"split_{n}")
        if df.count() != counts.get((n, "kept"), 0):
            raise AssertionError(f"{n}: rows written are not the rows counted")
        got.append(df.select(F.lit(n).alias("table"), "company", "VBELN", df["POSNR"] if "POSNR" in df.columns else F.lit("").alias("POSNR")))
    return S.union_all(got)


_LISTS_SQL = f"""
SELECT 'order_list' list, VKORG sales_org, count(*)::BIGINT rows, sum(ord_amt_lc)::DOUBLE amount FROM ol GROUP BY VKORG
UNION ALL SELECT 'delivery_list', VKORG, count(*), sum(coalesce(LFIMG,0) * {O.SG('SHKZG')})::DOUBLE FROM dc4
  WHERE abs(coalesce(LFIMG,0)) >= 0.000001 GROUP BY VKORG
UNION ALL SELECT 'invoice_list', VKORG, count(*), sum(inv_amt)::DOUBLE FROM il GROUP BY VKORG"""


def lists(c: Ctx, name: str, **switches):
    d = scratch(c, name)
    amount = {"order_list": "amount_lc_calc", "delivery_list": "qty_calc", "invoice_list": "amount_lc_calc"}
    out = []
    for k, df in PL.build_lists(c.spark, c.t, c.p, **switches).items():
        PL.write_stage(df, f"{d}/{k}", c.p, partition_by=())
        got = PL.read_stage(c.spark, f"{d}/{k}")
        out.append(got.groupBy("sales_org").agg(F.count(F.lit(1)).alias("rows"), F.sum(amount[k]).alias("amount"))
                   .select(F.lit(k).alias("list"), "sales_org", "rows", F.col("amount").cast("double")))
    return S.union_all(out)


@q("a18_lists_export", _LISTS_SQL)
def a18(c: Ctx):
    return lists(c, "a18")


@q("k1_run_lists", f"""
SELECT 'delivery_list' list, VKORG sales_org, count(*)::BIGINT rows, sum(coalesce(LFIMG,0) * {O.SG('SHKZG')})::DOUBLE amount
FROM lips l LEFT JOIN (SELECT MANDT, VBELN, VKORG FROM likp) h USING (MANDT, VBELN) GROUP BY VKORG
UNION ALL SELECT 'invoice_list', VKORG, count(*), sum(inv_amt)::DOUBLE FROM il GROUP BY VKORG""")
def k1(c: Ctx):
    """The lists by switches: no orders, the unfiltered delivery list, invoices."""
    return lists(c, "k1", orders=False, delivery_full=True)


_I1_SQL = f"""SELECT 'VBAK' AS "table", VBELN, '' POSNR, BUKRS_VF company FROM vbak
UNION ALL SELECT 'VBRK', VBELN, '', BUKRS FROM vbrk
UNION ALL SELECT 'VBAP', l.VBELN, l.POSNR, h.BUKRS_VF FROM vbap l JOIN vbak h USING (VBELN)
UNION ALL SELECT 'LIKP', VBELN, '', m.BUKRS FROM likp JOIN (
  SELECT VKORG, BUKRS FROM (SELECT VKORG, BUKRS, row_number() OVER (PARTITION BY VKORG ORDER BY r DESC, o DESC) rn
   FROM (SELECT VKORG, BUKRS_VF BUKRS, 0 r, VBELN o FROM vbak UNION ALL SELECT VKORG, BUKRS, 1, VBELN FROM vbrk) u) WHERE rn = 1) m USING (VKORG)"""


@q("i1_incremental_ingest", _I1_SQL)
def i1(c: Ctx):
    """Headers in two parts of different layouts; all lines and delivery headers arrive before the
    second part, so half of the lines are late; an idle run; a settling that runs twice."""
    d = scratch(c, "i1")
    odd = F.col("VBELN").cast("bigint") % 2 == 1
    code = {"VBAK": "BUKRS_VF", "VBRK": "BUKRS"}

    def run(table: str) -> None:
        how = {"company_col": code[table]} if table in code else {"company_map": f"{d}/VBAK"} if table == "VBAP" else {}
        ingest_stream(c.spark, f"{d}/landing", table, f"{d}/{table}", checkpoint=f"{d}/checkpoint-{table}", **how).awaitTermination()

    vbrk = c.t["VBRK"].select("MANDT", "VBELN", "VKORG", "BUKRS")
    put_parts(c, vbak(c).where(odd), f"{d}/landing", "VBAK")
    put_parts(c, vbrk.where(odd), f"{d}/landing", "VBRK")
    put_parts(c, c.t["VBAP"].select("MANDT", "VBELN", "POSNR", "NETWR"), f"{d}/landing", "VBAP")
    put_parts(c, c.t["LIKP"].select("MANDT", "VBELN", "VKORG"), f"{d}/landing", "LIKP")
    for table in ("VBAK", "VBRK", "VBAP", "LIKP"):
        run(table)

    def settled() -> None:
        settle(c.spark, f"{d}/VBAP", headers=f"{d}/VBAK")
        settle(c.spark, f"{d}/LIKP", vbak=f"{d}/VBAK", vbrk=f"{d}/VBRK")

    settled()
    put_parts(c, vbak(c).where(~odd).select(*VBAK[::-1]), f"{d}/landing", "VBAK", 1001)
    put_parts(c, vbrk.where(~odd), f"{d}/landing", "VBRK", 1001)
    for table in ("VBAK", "VBRK", "VBRK"):  # the last has nothing new
        run(table)
    settled()
    settled()
    got = []
    for table in ("VBAK", "VBRK", "VBAP", "LIKP"):
        df = read_settled(c.spark, f"{d}/{table}")
        got.append(df.select(F.lit(table).alias("table"), "VBELN", df["POSNR"] if table == "VBAP" else F.lit("").alias("POSNR"), "company"))
    return S.union_all(got)


@q("b16_staged_by_month", f"""
, hd AS (SELECT MANDT, VBELN, min({O.DT('FKDAT')}) d FROM vbrp GROUP BY MANDT, VBELN)
SELECT l.VBELN, l.POSNR FROM vbrp l JOIN hd USING (MANDT, VBELN)
WHERE (CASE WHEN l.POSNR::BIGINT % 20 = 0 THEN hd.d ELSE {O.DT('l.FKDAT')} END) BETWEEN DATE '{O._IF}' AND DATE '{O._IL}'""")
def b16_staged(c: Ctx):
    """Every other line has its date on the header only; staged by month, read by period."""
    dates = c.t["VBRP"].groupBy("MANDT", "VBELN").agg(F.min("FKDAT").alias("FKDAT"))
    vbrk = c.t["VBRK"].drop("FKDAT").join(dates, ["MANDT", "VBELN"], "left")
    bare = F.col("POSNR").cast("bigint") % 20 == 0
    vbrp = c.t["VBRP"].withColumn("FKDAT", F.when(~bare, F.col("FKDAT")))
    t = PL.stage_invoice_lines(c.spark, {"VBRK": vbrk, "VBRP": vbrp}, scratch(c, "b16"), c.p)
    return IV._period_lines(t["VBRK"], t["VBRP"], c.p).select("VBELN", "POSNR")


# ---------------------------------------------------------------------------
# whole runs (K2–K5): stages written and read back
# ---------------------------------------------------------------------------

def stored_match(c: Ctx, name: str) -> str:
    d = scratch(c, name)
    pv = M.build_pivots(c.spark, c.t, c.p).write(f"{d}/pivots")
    PL.write_stage(M.three_way_match(pv, c.p), f"{d}/matched", c.p)
    PL.write_stage(M.untested(pv, c.p), f"{d}/untested", c.p)
    pv.release(remove=True)
    return d


def stored_stats(c: Ctx, name: str) -> DataFrame:
    d = stored_match(c, name)
    m = PL.read_stage(c.spark, f"{d}/matched")
    an = PL.analyse(None, c.p, matched=m, untested=PL.read_stage(c.spark, f"{d}/untested"))
    PL.write_stage(an.stats, f"{d}/stats", c.p)
    return PL.read_stage(c.spark, f"{d}/stats")


@q("k2_run_match", f"SELECT {_MATCH_SQL_COLS} FROM mt")
def k2(c: Ctx):
    return PL.read_stage(c.spark, f"{stored_match(c, 'k2')}/matched").select(*MATCH_COLS)


@q("k3_run_diff", f"SELECT {_ST_COLS} FROM st")
def k3(c: Ctx):
    return stored_stats(c, "k3").select(*_ST_COLS.split(", "))


@q("k4_run_group_report", _rates_select("sb", 80.0, 60.0))
def k4(c: Ctx):
    return R.company_match_rate(stored_stats(c, "k4"), c.p, "reported").drop("_raw_pct_amt")


_FIRST_TEN = "SELECT company FROM (SELECT VKORG company FROM vbak UNION SELECT VKORG FROM likp UNION SELECT VKORG FROM vbrk) ORDER BY company LIMIT 10"


@q("k5_run_all_rerun", f"SELECT '9' batch, * FROM ({_rates_select('sb', 80.0, 60.0)}) UNION ALL SELECT '10', * FROM ("
   + _rates_select(f"(SELECT * FROM sb WHERE company IN ({_FIRST_TEN}))", 80.0, 60.0) + ")")
def k5(c: Ctx):
    """Batch 9 over all companies, then batch 10 of the first ten into the same folder; both batches' rates."""
    d = scratch(c, "k5")
    PL.run_all(c.spark, c.t, c.p, out_dir=d, batch_id="9")
    PL.run_all(c.spark, c.t, c.p, out_dir=d, batch_id="10", limit=10)
    return S.union_all([PL.open_run(c.spark, d, c.p, b).get("report_rates").select(F.lit(b).alias("batch"), "*") for b in ("9", "10")])


@q("d24_control_of_chosen", f"""
SELECT (SELECT count(*) FROM mt WHERE company IN ({_FIRST_TEN}))::BIGINT rows_out,
  (SELECT count(*) FROM ip WHERE VKORG IN ({_FIRST_TEN}))::BIGINT invoice_keys, 0::BIGINT fan_out,
  (SELECT count(*) FROM mt WHERE is_negative AND company IN ({_FIRST_TEN}))::BIGINT negative_rows,
  (SELECT sum(inv_amt) FROM ip WHERE VKORG IN ({_FIRST_TEN}))::DOUBLE invoice_total,
  (SELECT count(*) FROM ok WHERE n_materials > 1 AND VKORG IN ({_FIRST_TEN}))::BIGINT multi_material_keys,
  (SELECT count(*) FROM vbak WHERE {O.ST('KUNNR')} IN (SELECT code FROM excl) AND VKORG IN ({_FIRST_TEN}))::BIGINT order_headers_excluded,
  (SELECT count(*) FROM vbrk WHERE {O.ST('KUNAG')} IN (SELECT code FROM excl) AND VKORG IN ({_FIRST_TEN}))::BIGINT invoice_headers_excluded,
  (SELECT count(*) - count(DISTINCT VBELN) FROM likp WHERE VKORG IN ({_FIRST_TEN}))::BIGINT duplicate_delivery_headers""")
def d24_chosen(c: Ctx):
    """The control figures of the first ten companies, counted by the stage writes."""
    run = ST.StageRun(c.spark, scratch(c, "d24"), c.p)
    PL.match_stages(run, c.t, limit=10)
    return run.get("control")


# ---------------------------------------------------------------------------
# company code from the document headers
# ---------------------------------------------------------------------------

class CompanyCtx(Ctx):
    """By company code, with two companies in every sales organisation."""

    def __init__(self, c: Ctx):
        super().__init__(c.spark, c.sf_dir)
        self.p = fixture_params().with_(company_by="bukrs")
        self.t = fixture_tables(c.spark, c.sf_dir, two_company_views())


def company_chain(select: str) -> str:
    """The oracle's chain inside companies: the sales organisation of every
    header is written behind its company, so that all keys hold both."""
    chain = O.CHAIN
    for t in ("vbak", "likp", "vbrk"):
        chain = re.sub(rf"\b{t}\b", f"{t}2", chain)
    for a, b in (
            ("known AS (SELECT DISTINCT VBELN AS k FROM vbak2 WHERE VBELN IS NOT NULL)",
             "known AS (SELECT DISTINCT VBELN AS k, split_part(VKORG, '/', 1) AS c FROM vbak2 WHERE VBELN IS NOT NULL)"),
            ("dc4 AS (SELECT * FROM dj WHERE VBELV IN (SELECT k FROM known) OR VGBEL IN (SELECT k FROM known))",
             "dc4 AS (SELECT * FROM dj WHERE (split_part(VKORG, '/', 1), VBELV) IN (SELECT c, k FROM known) "
             "OR (split_part(VKORG, '/', 1), VGBEL) IN (SELECT c, k FROM known))"),
            ("VKORG AS company FROM mt0", "split_part(VKORG, '/', 1) AS company FROM mt0"),
            ("coalesce(o.VKORG, d.VKORG) AS company", "split_part(coalesce(o.VKORG, d.VKORG), '/', 1) AS company")):
        assert a in chain, a
        chain = chain.replace(a, b)
    head = "with " + ",\n".join(f"{n} as ({v})" for n, v in two_company_views())
    return head + """,
cmap AS (SELECT VKORG, BUKRS FROM (SELECT VKORG, BUKRS, row_number() OVER (PARTITION BY VKORG ORDER BY r DESC, o DESC) rn
  FROM (SELECT VKORG, BUKRS_VF BUKRS, 0 r, VBELN o FROM vbak UNION ALL SELECT VKORG, BUKRS, 1, VBELN FROM vbrk) u) WHERE rn = 1),
vbak2 AS (SELECT * REPLACE (BUKRS_VF || '/' || VKORG AS VKORG) FROM vbak),
likp2 AS (SELECT l.* REPLACE (m.BUKRS || '/' || l.VKORG AS VKORG) FROM likp l JOIN cmap m ON l.VKORG = m.VKORG),
vbrk2 AS (SELECT * REPLACE (BUKRS || '/' || VKORG AS VKORG) FROM vbrk),
""" + chain + select


def by_company(name: str, select: str):
    def deco(fn):
        REGISTRY[name] = (lambda c: fn(CompanyCtx(c)), company_chain(select))
        return fn
    return deco


_ORG = "split_part(VKORG, '/', 2) AS VKORG"


@by_company("c9_match_by_company_code", f"SELECT {_MATCH_SQL_COLS.replace('VKORG,', _ORG + ',', 1)} FROM mt")
def c9_code(c: Ctx):
    return c.stored.matched.select(*MATCH_COLS)


@by_company("c13_untested_by_company_code", f"SELECT company, {_ORG}, VBELN, POSNR, MATNR, AUART, ord_amt_fc::DOUBLE ord_amt_fc, "
            "ord_amt_lc::DOUBLE ord_amt_lc, ord_qty::DOUBLE ord_qty, dlv_qty::DOUBLE dlv_qty, dlv_docs, class FROM ut")
def c13_code(c: Ctx):
    return c.rec.untested.select(*UT_COLS)


@by_company("d7_stats_by_company_code", f"SELECT {_ST_COLS} FROM st")
def d7_code(c: Ctx):
    return c.st.stats


# ---------------------------------------------------------------------------
# all invoice dates: the whole driving side through the match
# ---------------------------------------------------------------------------

class AllDatesCtx(Ctx):
    def __init__(self, c: Ctx):
        super().__init__(c.spark, c.sf_dir)
        self.p = fixture_params().with_(invoice_period=None)


def over_all_dates(sql: str) -> str:
    """An oracle statement without its limit to the invoice year."""
    limit = f"WHERE {O.DT('FKDAT')} BETWEEN DATE '{O._IF}' AND DATE '{O._IL}'"
    assert limit in sql
    return sql.replace(limit, "WHERE true")


def all_dates(name: str, select: str):
    def deco(fn):
        REGISTRY[name] = (lambda c: fn(AllDatesCtx(c))), over_all_dates(O.with_chain(select))
        return fn
    return deco


@all_dates("c9_match_all_dates", f"SELECT {_MATCH_SQL_COLS} FROM mt")
def c9_all(c: Ctx):
    return c.stored.matched.select(*MATCH_COLS)


@all_dates("d7_stats_all_dates", f"SELECT {_ST_COLS} FROM st")
def d7_all(c: Ctx):
    return c.st.stats
