"""DuckDB oracle: the reconciliation written once more as plain SQL.

Used by the driver's correctness gate (``__spark_entry__.oracle_sql``) and
by the tests.  Every statement is one ``WITH`` query over the star-schema
views DuckDB already has; the six SAP-shaped tables are rebuilt from the
same fixture definition the Spark side uses, then every stage follows the

Parameters are those of :func:`triad.config.fixture_params` (invoice and
order period 1998, company = VKORG, static exclusion list).
"""

from __future__ import annotations

from .config import SCENARIO_CLASSES, fixture_params
from .sources.fixtures import fixture_cte_sql

P = fixture_params()
_IF, _IL = P.invoice_period.first_day.isoformat(), P.invoice_period.last_day.isoformat()
_OF, _OL = P.order_period.first_day.isoformat(), P.order_period.last_day.isoformat()


def B(x):  # blank document reference
    return f"(upper(trim(coalesce({x},''))) IN ('','NAN','0','000','000000'))"


def BP(x):  # blank batch-parent pointer
    return f"(trim(coalesce({x},'')) IN ('','0','000000'))"


def SG(x):  # debit/credit sign
    return f"(CASE WHEN upper(trim({x})) IN ('H','X') THEN -1 ELSE 1 END)"


def ST(x):  # normalised sold-to code
    return f"(CASE WHEN ltrim(trim(coalesce({x},'')),'0')='' THEN '0' ELSE ltrim(trim(coalesce({x},'')),'0') END)"


def NZ1(x):  # conversion factor, 0/null -> 1
    return f"(CASE WHEN coalesce({x},1)=0 THEN 1 ELSE coalesce({x},1) END)"


def DT(x):
    return f"try_strptime({x}, '%Y%m%d')::DATE"


def PCT(a, b):
    return (f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN NULL "
            f"ELSE (100.0::DOUBLE * ({a})::DOUBLE / ({b})::DOUBLE)::DECIMAL(18,4)::DOUBLE END)")


_EXCL = ", ".join(f"('{c}')" for c in P.static_exclusions)
_TYPES_EXCL = ", ".join(f"'{t}'" for t in P.order_type_exclude)
_DOCS = "coalesce(string_agg(DISTINCT nullif(trim({c}),''), ', ' ORDER BY nullif(trim({c}),'')), '')"

CHAIN = f"""
excl(code) AS (VALUES {_EXCL}),
ol AS (
  SELECT coalesce(h.VKORG,'') VKORG, coalesce(l.VBELN,'') VBELN, coalesce(l.POSNR,'') POSNR,
    CASE WHEN regexp_full_match(trim(coalesce(l.MATNR,'')), '0*') THEN '' ELSE trim(coalesce(l.MATNR,'')) END MATNR,
    l.MATNR MATNR_RAW, l.ARKTX, h.AUART, h.KUNNR, {DT('h.AUDAT')} order_date,
    CASE WHEN l.KLMENG IS NOT NULL AND abs(l.KLMENG) >= 0.000001 THEN l.KLMENG::DECIMAL(24,6)
         ELSE (coalesce(l.KWMENG,0) * coalesce(l.UMVKZ,1) / {NZ1('l.UMVKN')})::DECIMAL(24,6) END ord_qty,
    coalesce(l.NETWR,0) ord_amt_fc, coalesce(l.NETWR,0) * coalesce(l.WKURS,1) ord_amt_lc,
    l.KWMENG, l.KLMENG, l.NETWR, l.WKURS
  FROM vbap l LEFT JOIN vbak h ON l.MANDT=h.MANDT AND l.VBELN=h.VBELN
  WHERE {ST('h.KUNNR')} NOT IN (SELECT code FROM excl)),
op AS (SELECT VKORG, VBELN, POSNR, MATNR, sum(ord_amt_fc) ord_amt_fc, sum(ord_amt_lc) ord_amt_lc,
         sum(ord_qty) ord_qty, min(AUART) AUART FROM ol GROUP BY VKORG, VBELN, POSNR, MATNR),
mm AS (SELECT VKORG, VBELN, POSNR, MATNR, min(ARKTX) ARKTX FROM ol GROUP BY VKORG, VBELN, POSNR, MATNR),
ok0 AS (SELECT VKORG, VBELN, POSNR, sum(ord_amt_fc) ord_amt_fc, sum(ord_amt_lc) ord_amt_lc, sum(ord_qty) ord_qty,
         min(MATNR) MATNR, min(AUART) AUART, count(DISTINCT MATNR) n_materials FROM ol GROUP BY VKORG, VBELN, POSNR),
ok AS (SELECT k.*, mm.ARKTX FROM ok0 k LEFT JOIN mm ON k.VKORG=mm.VKORG AND k.VBELN=mm.VBELN
         AND k.POSNR=mm.POSNR AND k.MATNR=mm.MATNR),
likp1 AS (SELECT * FROM likp QUALIFY row_number() OVER (PARTITION BY MANDT, VBELN ORDER BY VBELN) = 1),
lips1 AS (SELECT * FROM lips QUALIFY row_number() OVER (PARTITION BY MANDT, VBELN, POSNR ORDER BY s, pk, q, x) = 1),
dj AS (SELECT l.*, h.VKORG, h.LFART FROM lips1 l LEFT JOIN likp1 h ON l.MANDT=h.MANDT AND l.VBELN=h.VBELN),
known AS (SELECT DISTINCT VBELN AS k FROM vbak WHERE VBELN IS NOT NULL),
dc4 AS (SELECT * FROM dj WHERE VBELV IN (SELECT k FROM known) OR VGBEL IN (SELECT k FROM known)),
dl AS (SELECT *, VBELN AS dlv_no,
    CASE WHEN {B('VBELV')} THEN VGBEL ELSE VBELV END ORD_VBELN,
    CASE WHEN {B('POSNV')} THEN VGPOS ELSE POSNV END ORD_POSNR,
    (CASE WHEN abs(coalesce(LGMNG,0)) >= 0.000001 THEN LGMNG::DECIMAL(24,6)
          ELSE (coalesce(LFIMG,0) * {NZ1('UMVKN')} / {NZ1('UMVKZ')})::DECIMAL(24,6) END) * {SG('SHKZG')} AS dlv_qty
  FROM dc4 WHERE abs(coalesce(LFIMG,0)) >= 0.000001),
par AS (SELECT DISTINCT VBELN pv, POSNR pp FROM dl WHERE {BP('UEPOS')} AND {BP('UECHA')}),
dl2 AS (SELECT d.* FROM dl d
  WHERE ({BP('d.UEPOS')} AND {BP('d.UECHA')})
     OR (NOT EXISTS (SELECT 1 FROM par WHERE par.pv = d.VBELN AND par.pp = d.UEPOS AND NOT {BP('d.UEPOS')})
         AND NOT EXISTS (SELECT 1 FROM par WHERE par.pv = d.VBELN AND par.pp = d.UECHA AND NOT {BP('d.UECHA')}))),
dp AS (SELECT VKORG, ORD_VBELN AS VBELN, ORD_POSNR AS POSNR, sum(dlv_qty) dlv_qty, {_DOCS.format(c='dlv_no')} dlv_docs
  FROM dl2 WHERE VKORG IS NOT NULL AND ORD_VBELN IS NOT NULL AND ORD_POSNR IS NOT NULL
  GROUP BY VKORG, ORD_VBELN, ORD_POSNR),
ij AS (SELECT l.*, h.VKORG, h.FKART, h.KUNAG, h.BUKRS FROM vbrp l LEFT JOIN vbrk h ON l.MANDT=h.MANDT AND l.VBELN=h.VBELN),
il AS (SELECT *, VBELN AS inv_no,
    CASE WHEN {B('AUBEL')} OR {B('AUPOS')} THEN VBELV ELSE AUBEL END ORD_VBELN,
    CASE WHEN {B('AUBEL')} OR {B('AUPOS')} THEN POSNV ELSE AUPOS END ORD_POSNR,
    coalesce(NETWR,0) * {SG('SHKZG')} inv_amt,
    (CASE WHEN abs(coalesce(FKLMG,0)) >= 0.000001 THEN FKLMG::DECIMAL(24,6)
          ELSE (coalesce(FKIMG,0) * {NZ1('UMVKN')} / {NZ1('UMVKZ')})::DECIMAL(24,6) END) * {SG('SHKZG')} inv_qty
  FROM ij
  WHERE {DT('FKDAT')} BETWEEN DATE '{_IF}' AND DATE '{_IL}'
    AND {ST('KUNAG')} NOT IN (SELECT code FROM excl)
    AND (abs(coalesce(FKIMG,0)) >= 0.000001 OR abs(coalesce(NETWR,0)) >= 0.000001)),
ip AS (SELECT VKORG, ORD_VBELN AS VBELN, ORD_POSNR AS POSNR, sum(inv_amt) inv_amt, sum(inv_qty) inv_qty,
    min(FKART) inv_type, {_DOCS.format(c='inv_no')} inv_docs
  FROM il WHERE VKORG IS NOT NULL AND ORD_VBELN IS NOT NULL AND ORD_POSNR IS NOT NULL
  GROUP BY VKORG, ORD_VBELN, ORD_POSNR),
mt0 AS (SELECT i.VKORG, i.VBELN, i.POSNR, o.AUART, i.inv_docs, i.inv_type, d.dlv_docs,
    round_even(coalesce(i.inv_qty,0),2) inv_qty, round_even(coalesce(i.inv_amt,0),2) inv_amt,
    round_even(coalesce(d.dlv_qty,0),2) dlv_qty, round_even(coalesce(o.ord_qty,0),2) ord_qty,
    round_even(coalesce(o.ord_amt_lc,0),2) ord_amt_lc, round_even(coalesce(o.ord_amt_fc,0),2) ord_amt_fc,
    o.MATNR, o.ARKTX, d.VKORG IS NULL delivery_missing, o.VKORG IS NULL order_missing,
    coalesce(o.n_materials,0) n_materials
  FROM ip i LEFT JOIN dp d ON i.VKORG=d.VKORG AND i.VBELN=d.VBELN AND i.POSNR=d.POSNR
            LEFT JOIN ok o ON i.VKORG=o.VKORG AND i.VBELN=o.VBELN AND i.POSNR=o.POSNR),
mt AS (SELECT *, ord_amt_lc - inv_amt amt_diff, ord_qty - dlv_qty od_qty_diff, ord_qty - inv_qty oi_qty_diff,
    dlv_qty - inv_qty di_qty_diff, (abs(ord_qty) < 0.01 AND abs(dlv_qty) < 0.01 AND inv_amt < -0.01) is_negative,
    VKORG AS company FROM mt0),
cl0 AS (SELECT *, abs(oi_qty_diff) < 0.01 q, abs(ord_qty - dlv_qty) < 0.01 d_raw, abs(amt_diff) < 0.01 a_eq,
    amt_diff < -0.01 a_lt, amt_diff > 0.01 a_gt, CASE WHEN ord_qty = 0 THEN 1 ELSE ord_qty END os
  FROM mt WHERE NOT is_negative),
cl1 AS (SELECT *, (q AND a_eq AND NOT d_raw AND abs(dlv_qty - 4*os) < 0.05*abs(os)) unit_fix FROM cl0),
cl2 AS (SELECT *, d_raw OR unit_fix dd FROM cl1),
cl AS (SELECT * EXCLUDE (dlv_qty, q, d_raw, a_eq, a_lt, a_gt, os, dd), dlv_qty AS dlv_qty_raw,
    CASE WHEN unit_fix THEN ord_qty ELSE dlv_qty END AS dlv_qty,
    CASE WHEN q AND dd AND a_eq THEN 10 WHEN q AND dd AND a_lt THEN 8 WHEN q AND dd AND a_gt THEN 9
         WHEN q AND NOT dd AND a_eq THEN 3 WHEN q AND NOT dd AND a_lt THEN 1 WHEN q AND NOT dd AND a_gt THEN 2
         WHEN NOT q AND dd AND a_eq THEN 11 WHEN NOT q AND dd AND a_lt THEN 12 WHEN NOT q AND dd AND a_gt THEN 13
         WHEN NOT q AND NOT dd AND a_eq THEN 6 WHEN NOT q AND NOT dd AND a_lt THEN 4
         WHEN NOT q AND NOT dd AND a_gt THEN 5 ELSE 0 END AS scenario
  FROM cl2),
ut AS (SELECT coalesce(o.VKORG, d.VKORG) VKORG, coalesce(o.VBELN, d.VBELN) VBELN, coalesce(o.POSNR, d.POSNR) POSNR,
    o.MATNR, o.AUART, o.ord_amt_fc, o.ord_amt_lc, o.ord_qty, d.dlv_qty, d.dlv_docs,
    CASE WHEN d.VKORG IS NULL THEN 'order_only' WHEN o.VKORG IS NULL THEN 'delivery_only'
         ELSE 'order_delivery' END AS class,
    coalesce(o.VKORG, d.VKORG) AS company
  FROM op o FULL OUTER JOIN dp d ON o.VKORG=d.VKORG AND o.VBELN=d.VBELN AND o.POSNR=d.POSNR
  WHERE NOT EXISTS (SELECT 1 FROM ip i WHERE i.VKORG = coalesce(o.VKORG, d.VKORG)
        AND i.VBELN = coalesce(o.VBELN, d.VBELN) AND i.POSNR = coalesce(o.POSNR, d.POSNR))),
sr AS (SELECT company, scenario, inv_amt::DECIMAL(38,2) amt, (ord_amt_lc - inv_amt)::DECIMAL(38,2) diff FROM cl
  UNION ALL SELECT company, 7, NULL, NULL FROM ut WHERE class IN ('order_only', 'order_delivery')
  UNION ALL SELECT company, 14, inv_amt::DECIMAL(38,2), NULL FROM mt WHERE is_negative),
sco AS (SELECT company, count(*) FILTER (WHERE scenario NOT IN (7, 14)) n,
    sum(amt) FILTER (WHERE scenario NOT IN (7, 14) AND amt > 0) p, sum(amt) FILTER (WHERE scenario NOT IN (7, 14)) t,
    count(*) FILTER (WHERE scenario <> 7) tested FROM sr GROUP BY company),
sdim AS (SELECT company, n, p, t, unnest(range(0, 15)) AS scenario FROM sco WHERE tested > 0),
sg AS (SELECT company, scenario, count(*) c, sum(amt) a, sum(diff) d FROM sr GROUP BY company, scenario),
st AS (SELECT x.company, x.scenario::BIGINT scenario, coalesce(g.c, 0)::BIGINT AS rows,
    {PCT('coalesce(g.c,0)', 'CASE WHEN x.scenario IN (7,14) THEN x.n + coalesce(g.c,0) ELSE x.n END')} pct_rows,
    coalesce(g.a, 0)::DOUBLE inv_amt,
    CASE WHEN x.scenario = 7 THEN NULL
         ELSE {PCT('coalesce(g.a,0)', 'CASE WHEN x.p > 0 THEN x.p ELSE coalesce(x.t,0) END')} END pct_amt,
    coalesce(g.d, 0)::DOUBLE order_inv_diff,
    x.scenario IN (1,2,3,4,5,6,7,8,9,11,12,13,14) AS reported
  FROM sdim x LEFT JOIN sg g ON x.company = g.company AND x.scenario = g.scenario),
sb AS (SELECT company, scenario,
    CASE WHEN reported THEN rows ELSE 0 END rows,
    CASE WHEN reported THEN inv_amt ELSE 0 END::DECIMAL(38,2) inv_amt,
    CASE WHEN reported THEN order_inv_diff ELSE 0 END::DECIMAL(38,2) order_inv_diff FROM st),
sbf AS (SELECT company, scenario,
    CASE WHEN reported OR scenario = 10 THEN rows ELSE 0 END rows,
    CASE WHEN reported OR scenario = 10 THEN inv_amt ELSE 0 END::DECIMAL(38,2) inv_amt,
    CASE WHEN reported OR scenario = 10 THEN order_inv_diff ELSE 0 END::DECIMAL(38,2) order_inv_diff FROM st),
vo AS (SELECT VBELN FROM vbak QUALIFY row_number() OVER (PARTITION BY VBELN ORDER BY VBELN) = 1
    AND {DT('AUDAT')} BETWEEN DATE '{_OF}' AND DATE '{_OL}'
    AND upper(trim(coalesce(AUART,''))) NOT IN ({_TYPES_EXCL})
    AND {ST('KUNNR')} NOT IN (SELECT code FROM excl))
"""


def with_chain(select: str) -> str:
    """A full oracle statement: fixture views + stage chain + ``select``."""
    return fixture_cte_sql() + "," + CHAIN + select


def _classes_sql(src: str) -> str:
    parts = []
    for name, ids in SCENARIO_CLASSES:
        parts.append(f"WHEN scenario IN ({', '.join(str(i) for i in ids)}) THEN '{name}'")
    return f"(CASE {' '.join(parts)} END)"


def rates_sql(src: str, high: float, mid: float) -> str:
    """Company match rates over a basis table (sb / sbf)."""
    none_ids = ", ".join(str(i) for i in dict(SCENARIO_CLASSES)["none"])
    all4 = ", ".join(str(i) for _, ids in SCENARIO_CLASSES for i in ids)
    return f"""(SELECT company, mr, tr, ma, ta, na,
      CASE WHEN ta > 0 THEN ma::DOUBLE * 100.0 / ta::DOUBLE ELSE 0.0 END raw_pa FROM (
      SELECT company,
        sum(CASE WHEN scenario IN ({none_ids}) THEN rows ELSE 0 END) mr,
        sum(CASE WHEN scenario IN ({all4}) THEN rows ELSE 0 END) tr,
        coalesce(sum(CASE WHEN scenario IN ({none_ids}) THEN inv_amt END), 0) ma,
        coalesce(sum(CASE WHEN scenario IN ({all4}) THEN inv_amt END), 0) ta,
        coalesce(sum(CASE WHEN scenario = 14 THEN inv_amt END), 0) na
      FROM {src} GROUP BY company) WHERE ta > 0 OR tr > 0)"""


def tier_sql(high: float, mid: float) -> str:
    return f"(CASE WHEN raw_pa >= {high} THEN 'high' WHEN raw_pa >= {mid} THEN 'mid' ELSE 'low' END)"
