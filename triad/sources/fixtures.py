"""Test input: six SAP-shaped tables derived from the star-schema test data.

The SELECTs below are a test-input definition (see FIXTURES.md §3), written
in the SQL subset Spark and DuckDB share so the DuckDB oracle can build the
very same rows.  They are not engine code: the pipeline only ever sees the
six conformed tables returned by :func:`fixture_tables`.

``lips`` carries ``s, pk, q, x`` only to give "keep first" a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .extract import conform

STAR_TABLES = ("orders", "lineitem", "customer", "nation", "part")

# name -> SELECT, in dependency order
FIXTURE_VIEWS: list[tuple[str, str]] = [
    ("vbak", """
select '100' MANDT, lpad(cast(o_orderkey as string),10,'0') VBELN, cast(4000+10*c_nationkey as string) VKORG,
 cast(5000+n_regionkey as string) BUKRS_VF,
 cast(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) as string) AUDAT,
 case o_orderpriority when '2-HIGH' then 'AB' when '4-NOT SPECIFIED' then 'ZRE' else 'ZOR' end AUART,
 case when o_custkey%40=0 then lpad(cast(4000+10*(o_custkey%25) as string),10,'0')
      else lpad(cast(100000+o_custkey as string),10,'0') end KUNNR,
 cast(o_totalprice as decimal(18,2)) NETWR, 'CNY' WAERK
from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey"""),
    ("li", """
select *, l_orderkey lk, l_linenumber ln, l_partkey pk, l_suppkey%10 s, cast(l_quantity as decimal(18,3)) q,
 cast(l_extendedprice as decimal(18,2)) x,
 lpad(cast(l_orderkey as string),10,'0') ord, lpad(cast(l_linenumber*10 as string),6,'0') pos,
 '8'||lpad(cast(l_orderkey as string),9,'0') dlv, '9'||lpad(cast(l_orderkey as string),9,'0') inv
from lineitem"""),
    ("vbap", """
select '100' MANDT, ord VBELN, pos POSNR,
 case when pk%50=0 then '000000000000000000' else lpad(cast(pk as string),18,'0') end MATNR, p_name ARKTX,
 case when pk%3=0 then cast(q/2 as decimal(18,3)) else q end KWMENG, case when pk%3=0 then null else q end KLMENG,
 case when pk%3=0 then 2 else 1 end UMVKZ, 1 UMVKN,
 x NETWR, case when pk%29=0 then 2 else 1 end WKURS
from li join part on pk=p_partkey where s<>9"""),
    ("likp", """
select distinct '100' MANDT, dlv VBELN, VKORG, case when lk%17=0 then 'RL' else 'LF' end LFART
from li join vbak on ord=VBELN"""),
    ("lips", """
select '100' MANDT, dlv VBELN, pos POSNR, '000000' UEPOS, '000000' UECHA, case when lk%2=0 then ord else '' end VBELV,
  case when lk%2=0 then pos else '000000' end POSNV, ord VGBEL, pos VGPOS,
  case when pk%13=0 then 0 when pk%3=0 then 2*b else b end LFIMG, case when pk%3=0 then null else b end LGMNG,
  case when pk%3=0 then 2 else 1 end UMVKZ, 1 UMVKN,
  case when lk%17=0 then 'X' else null end SHKZG, s, pk, q, x
  from (select *, case s when 4 then 4*q when 5 then q-1 else q end b from li where s<>7 and not (s=9 and pk%2=0)) t
 union all
 select '100', dlv, '9'||lpad(cast(ln as string),5,'0'), '000000', pos, '', '000000', ord, pos, q, q, 1, 1, null,
  s, pk, q, x from li where pk%7=0 and s<>7 and s<>9"""),
    ("vbrk", """
select distinct '100' MANDT, inv VBELN, VKORG, BUKRS_VF BUKRS, KUNNR KUNAG,
 case when lk%19=0 then 'ZS1' else 'ZF2' end FKART
from li join vbak on ord=VBELN"""),
    ("vbrp", """
select '100' MANDT, inv VBELN, pos POSNR, dlv VBELV, pos POSNV, case when pk%23=0 then '' else ord end AUBEL,
  case when pk%23=0 then '000000' else pos end AUPOS,
  case when pk%5=0 then q+1 else q end FKIMG,
  case when pk%3=0 then null else case when pk%5=0 then q+1 else q end end FKLMG, 1 UMVKZ, 1 UMVKN,
  case when l_discount<0.035 then x when l_discount<0.065 then x-10 else x+10 end NETWR,
  case when s=9 and pk%2=0 then 'X' when lk%19=0 then 'H' else 'S' end SHKZG,
  cast(year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) as string) FKDAT
 from li where s<>8"""),
]

# Row order used for "keep first" in each fixture table (file order stand-in).
FIXTURE_ORDER = {
    "VBAK": ["VBELN"],
    "VBAP": ["VBELN", "POSNR", "MATNR", "ARKTX", "KWMENG", "NETWR"],
    "LIKP": ["VBELN"],
    "LIPS": ["s", "pk", "q", "x"],
    "VBRK": ["VBELN"],
    "VBRP": ["VBELN", "POSNR"],
}


def fixture_cte_sql() -> str:
    """The views as a ``WITH`` prefix for DuckDB oracle statements."""
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in FIXTURE_VIEWS) + "\n"


def two_company_views() -> list[tuple[str, str]]:
    """The views with two company codes in every sales organisation."""
    one, two = "cast(5000+n_regionkey as string)", "cast(5000+n_regionkey+100*(o_custkey%2) as string)"
    return [(n, q.replace(one, two)) for n, q in FIXTURE_VIEWS]


# Both header views take distinct rows of lines joined to their orders and use nothing of a
# line but its order key and the numbers made from it.  Spark cuts the lines to these before
# the join; the rows are the same, with one join row to an order instead of one to a line.
_LINES_OF_ORDERS = "from li join vbak on ord=VBELN"
_KEYS_OF_ORDERS = """from (
 select lk, lpad(cast(lk as string),10,'0') ord, '8'||lpad(cast(lk as string),9,'0') dlv, '9'||lpad(cast(lk as string),9,'0') inv
 from (select distinct l_orderkey lk from lineitem)) join vbak on ord=VBELN"""


def fixture_tables(spark: SparkSession, sf_dir: str, views: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Register the star tables and return the six conformed SAP tables."""
    for t in STAR_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, q in views or FIXTURE_VIEWS:
        spark.sql(q.replace(_LINES_OF_ORDERS, _KEYS_OF_ORDERS)).createOrReplaceTempView(name)
    out = {}
    for table in ("VBAK", "VBAP", "LIKP", "LIPS", "VBRK", "VBRP"):
        raw = spark.table(table.lower())
        out[table] = conform(raw, table, order_cols=FIXTURE_ORDER[table])
    return out
