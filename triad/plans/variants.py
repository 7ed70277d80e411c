"""Registered queries on variants of the fixture: every stage over all invoice
dates, and rows that the plain fixture does not have (units, line numbers in
several spellings, materials with leftovers of other tools, batch children by
either pointer).  All rows derive from the given tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions import exprs as X
from ..operators import deliveries as DV
from ..operators import scenarios as S
from ..sources.fixtures import FIXTURE_VIEWS, fixture_tables
from .catalog import REGISTRY, Ctx, q
from .roundtrips import AllDatesCtx, over_all_dates

# ---------------------------------------------------------------------------
# all invoice dates: everything behind the invoice lines
# ---------------------------------------------------------------------------

ALL_DATES = (
    "c3_invoice_lines", "c13_untested_outer", "c14_verify_lookup",
    "b29_negative_invoice", "b30_unit_ratio_fix", "b31_scenario", "b33_detail_projection", "b35_scale_scenario_diff",
    "d4_invoice_pivot", "d5_concat_doc_numbers", "d6_first_invoice_type", "d11_backfill_diff", "d12_group_scenarios",
    "d13_scenario_table", "d14_four_classes", "d15_company_match_rate", "d15_company_match_rate_reported",
    "d16_tier_summary", "d17_overall_match", "d18_sensitivity", "d18_removed_companies", "d19_internal_only_flag",
    "d20_untested_summary", "d21_legacy_scenarios", "d22_missing_invoice_amount", "d23_verify_summary",
    "d24_control_totals", "d24_control_of_chosen", "k2_run_match", "k3_run_diff", "k4_run_group_report",
)

for _name in ALL_DATES:
    _fn, _sql = REGISTRY[_name]
    REGISTRY[f"{_name}_all_dates"] = (lambda c, _f=_fn: _f(AllDatesCtx(c))), over_all_dates(_sql)


@q("b34_detail_without_scenario10", "SELECT company, VKORG, VBELN, POSNR, scenario::BIGINT scenario, inv_amt::DOUBLE inv_amt "
   "FROM cl WHERE scenario NOT IN (0, 10)")
def b34_detail(c: Ctx):
    _, detail = S.drop_scenario10(c.an.stats, c.an.detail)
    return detail.select("company", "VKORG", "VBELN", "POSNR", "scenario", "inv_amt")


# ---------------------------------------------------------------------------
# rows that bite: B21, B37, B38, C8
# ---------------------------------------------------------------------------

_UNITS = "case pk%3 when 0 then 'ST' when 1 then ' ' else null end VRKME, case when pk%2=0 then 'KG' else '' end MEINS"
_CHANGES = (
    # a sales unit, a base unit, both or none
    ("else null end SHKZG, s, pk, q, x", f"else null end SHKZG, {_UNITS}, s, pk, q, x"),
    ("q, q, 1, 1, null,\n", f"q, q, 1, 1, null, {_UNITS},\n"),
    # children that point to their parent by UEPOS as well as by UECHA
    ("'9'||lpad(cast(ln as string),5,'0'), '000000', pos,",
     "'9'||lpad(cast(ln as string),5,'0'), case when pk%2=0 then pos else '000000' end, case when pk%2=0 then '0' else pos end,"),
    # line numbers short, long, blank-padded and with letters
    ("inv VBELN, pos POSNR, dlv VBELV",
     "inv VBELN, case pk%5 when 1 then cast(10*ln as string) when 2 then '0000'||pos when 3 then ' '||pos when 4 then 'A'||cast(ln as string) "
     "else pos end POSNR, dlv VBELV"),
    # materials read back as numbers, or with a zero-width character
    ("else lpad(cast(pk as string),18,'0') end MATNR",
     "else lpad(cast(pk as string),18,'0')||case pk%5 when 1 then '.0' when 2 then '​' when 3 then '.00​' when 4 then '.05' "
     "else '' end end MATNR"),
)


def varied_views() -> list[tuple[str, str]]:
    views = FIXTURE_VIEWS
    for old, new in _CHANGES:
        assert sum(old in sql for _, sql in views) == 1, old
        views = [(name, sql.replace(old, new)) for name, sql in views]
    return views


class VariedCtx(Ctx):
    def __init__(self, c: Ctx):
        super().__init__(c.spark, c.sf_dir)
        self.t = fixture_tables(c.spark, c.sf_dir, varied_views())


def varied(name: str, select: str):
    def deco(fn):
        head = "with " + ",\n".join(f"{n} as ({v})" for n, v in varied_views())
        REGISTRY[name] = (lambda c: fn(VariedCtx(c))), head + "," + O.CHAIN + select
        return fn
    return deco


@varied("b21_delivery_unit_varied", "SELECT VBELN, POSNR, "
        "coalesce(nullif(trim(VRKME), ''), nullif(trim(MEINS), ''), '') qty_unit FROM lips")
def b21_varied(c: Ctx):
    return c.t["LIPS"].select("VBELN", "POSNR", X.delivery_unit().alias("qty_unit"))


@varied("b37_posnr_varied", """
SELECT VBELN, trim(POSNR) POSNR, CASE WHEN regexp_full_match(trim(POSNR), '[0-9]+')
  THEN right('000000' || ltrim(trim(POSNR), '0'), 6) ELSE trim(POSNR) END posnr_norm FROM vbrp""")
def b37_varied(c: Ctx):
    return c.t["VBRP"].select("VBELN", F.trim("POSNR").alias("POSNR"), X.posnr_norm("POSNR").alias("posnr_norm"))


@varied("b38_material_cleanup_varied", "SELECT VKORG, VBELN, POSNR, "
        "regexp_replace(replace(MATNR, '​', ''), '\\.0+$', '') MATNR FROM cl WHERE scenario NOT IN (0, 10)")
def b38_varied(c: Ctx):
    return c.an.detail.select("VKORG", "VBELN", "POSNR", X.material_cleanup("MATNR").alias("MATNR"))


@varied("c8_batch_children_varied", "SELECT VBELN, POSNR, UEPOS, UECHA, dlv_qty::DOUBLE dlv_qty FROM dl2")
def c8_varied(c: Ctx):
    return c.delivery_lines.select("VBELN", "POSNR", "UEPOS", "UECHA", "dlv_qty")


@varied("c8_dropped_children_varied", "SELECT VBELN, POSNR FROM dl EXCEPT ALL SELECT VBELN, POSNR FROM dl2")
def c8_dropped(c: Ctx):
    before = DV.delivery_lines(c.t["LIKP"], c.t["LIPS"], c.known, c.p, batch_dedup=False)
    return before.select("VBELN", "POSNR").exceptAll(c.delivery_lines.select("VBELN", "POSNR"))


@varied("d3_delivery_pivot_varied", "SELECT VKORG, VBELN, POSNR, dlv_qty::DOUBLE dlv_qty, dlv_docs FROM dp")
def d3_varied(c: Ctx):
    return c.rec.pivots.delivery.drop("company")
