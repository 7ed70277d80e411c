"""User-level entry points (K1–K5): lists, reconcile, analyse, group report
and the whole run.

Each stage returns lazy DataFrames.  :func:`run_all` writes every stage as a
Parquet dataset partitioned by company (the stage boundary the process kept
as workbooks), which also cuts lineage: a lost executor recomputes from the
last written stage, never from the raw extracts.  How stages are written, read
and published is in :mod:`.stages`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Params
from ..operators import matching as M
from ..operators import report as R
from ..operators import scenarios as S
from ..operators import verify as V
from ..operators.common import exclusion_set
from ..operators.company import UNKNOWN, UNMAPPED, header_companies, select_companies, split_tables, tag_headers
from ..operators.deliveries import delivery_list, known_orders
from ..operators.invoices import MONTH, by_billing_month, invoice_list
from ..operators.orders import order_list
from ..session import scratch_folder, stage_dir, written
from .stages import StageRun, open_run, read_stage, write_stage


@dataclass
class Reconciled:
    """K2 output: match rows, tested rows, negative invoices, untested."""

    pivots: M.Pivots
    matched: DataFrame
    main: DataFrame
    negative: DataFrame
    untested: DataFrame

    def control(self) -> DataFrame:
        return M.control_totals(self.pivots, self.matched)

    def release(self) -> None:
        """Drop the persisted pivots once the stage outputs are written."""
        self.pivots.unpersist()


@dataclass
class Analysis:
    """K3 output: classified rows, statistics and the detail."""

    classified: DataFrame
    stats: DataFrame
    detail: DataFrame


@dataclass
class GroupReport:
    """K4 output."""

    scenarios: DataFrame
    table: DataFrame
    classes: DataFrame
    rates: DataFrame
    tiers: DataFrame
    overall: DataFrame
    sensitivity: DataFrame
    internal_only: DataFrame
    extra: dict = field(default_factory=dict)


def reconcile(spark: SparkSession, t: dict[str, DataFrame], p: Params, persist: bool = False) -> Reconciled:
    """K2: three-way match with negative-invoice split and untested classes.

    ``persist=True`` keeps the pivots between the match and the untested
    writes (call :meth:`Reconciled.release` afterwards).  Off by default:
    measured at sf0.1, building the cache costs more than recomputing the
    pivots; worth it only where the pivot inputs are expensive to re-read.
    """
    pv = M.build_pivots(spark, t, p)
    if persist:
        pv.persist()
    return reconciled(pv, p)


def reconcile_stored(spark: SparkSession, t: dict[str, DataFrame], p: Params, figures: bool = False) -> Reconciled:
    """K2 from pivots written once, in buckets: no document is read, joined or aggregated twice for
    readers of both the match and the untested rows, and the shuffles of each pivot are gone
    before the next is made.  ``figures``: the pivots' keys and figures only."""
    pv = M.build_pivots(spark, t, p)
    pv = pv.figures_only() if figures else pv
    return reconciled(pv.write(scratch_folder(spark, "pivots"), control=False), p)


def reconcile_figures(spark: SparkSession, t: dict[str, DataFrame], p: Params) -> Reconciled:
    """K2 for the statistics (:func:`reconcile_stored`, figures only)."""
    return reconcile_stored(spark, t, p, figures=True)


def reconciled(pv: M.Pivots, p: Params) -> Reconciled:
    matched = M.three_way_match(pv, p)
    return Reconciled(pv, matched, M.main_rows(matched), M.negative_invoices(matched), M.untested(pv, p))


def analyse(rec: Reconciled | None, p: Params, main: DataFrame | None = None, negative: DataFrame | None = None,
            untested: DataFrame | None = None, matched: DataFrame | None = None) -> Analysis:
    """K3: scenarios, statistics and detail (from a reconcile result or from
    stored stage data: ``matched``, or its parts ``main`` and ``negative``).
    The statistics read the match once where they have it whole."""
    untested = untested if untested is not None else rec.untested
    if matched is None and main is None and negative is None:
        matched = rec.matched
    if matched is not None:
        classified = S.with_scenario(M.main_rows(matched), p)
        return Analysis(classified, S.scenario_stats(S.with_negative(matched, p), untested), S.detail(classified))
    classified = S.with_scenario(main if main is not None else rec.main, p)
    negative = negative if negative is not None else rec.negative
    return Analysis(classified, S.scenario_stats(classified, untested, negative), S.detail(classified))


def group_report(spark: SparkSession, stats: DataFrame, p: Params, basis: str = "reported",
                 hide_order_inv_diff: bool = False) -> GroupReport:
    """K4: the group workbook as DataFrames."""
    rates = R.company_match_rate(stats, p, basis)
    return GroupReport(
        scenarios=R.group_scenarios(stats),
        table=R.scenario_table(stats, basis, hide_order_inv_diff=hide_order_inv_diff),
        classes=R.four_classes(stats, basis),
        rates=rates.drop("_raw_pct_amt"),
        tiers=R.tier_summary(spark, rates),
        overall=R.overall_match(rates),
        sensitivity=R.sensitivity(rates, p),
        internal_only=R.internal_only(stats, basis),
        extra={"removed": R.removed_companies(rates, p)},
    )


def build_lists(spark: SparkSession, t: dict[str, DataFrame], p: Params, orders: bool = True,
                deliveries: bool = True, invoices: bool = True, delivery_full: bool = False) -> dict:
    """The three lists, each switchable; ``delivery_full`` gives
    the unfiltered delivery list instead."""
    excl = exclusion_set(spark, p, t["VBAK"], t["VBRK"])
    out = {}
    if orders:
        out["order_list"] = order_list(t["VBAK"], t["VBAP"], excl, p)
    if deliveries:
        out["delivery_list"] = delivery_list(t["LIKP"], t["LIPS"], known_orders(t["VBAK"]), p, full=delivery_full)
    if invoices:
        out["invoice_list"] = invoice_list(t["VBRK"], t["VBRP"], excl, p)
    return out


def stage_invoice_lines(spark: SparkSession, t: dict[str, DataFrame], path: str, p: Params) -> dict[str, DataFrame]:
    """The tables with VBRP staged in folders by billing month."""
    write_stage(by_billing_month(t["VBRK"], t["VBRP"]), path, p, partition_by=(MONTH,))
    return {**t, "VBRP": read_stage(spark, path)}


def scenario_extract(detail_rows: DataFrame, companies: list[str] | None = None) -> DataFrame:
    """Detail rows of all companies regrouped by scenario (0 and 10
    skipped), optionally restricted to some companies; write it with
    ``partition_by=("scenario",)``."""
    d = detail_rows.where(~F.col("scenario").isin(0, 10))
    if companies:
        d = d.where(F.col("company").isin(*companies))
    return d


REPORTS = ("scenarios", "table", "classes", "rates", "tiers", "overall", "sensitivity", "internal_only")
TABLES = ("VBAK", "VBAP", "LIKP", "LIPS", "VBRK", "VBRP")


def write_split(run: StageRun, t: dict[str, DataFrame], p: Params) -> DataFrame:
    """The six tables as stages ``split_<table>``, in folders by company.  The rows
    without a company are counted by the same writes and left out; returns (table, status, rows)."""
    counts = []
    code = F.col("company")
    for name, df in split_tables(t, p.company_by).items():
        kept = ~code.isin(UNKNOWN, UNMAPPED)
        seen = run.put(f"split_{name}", df, observe={s: F.count(F.when(code == s if s != "kept" else kept, 1)) for s in ("kept", UNKNOWN, UNMAPPED)}, keep=kept)
        counts += [(name, s, n) for s, n in seen.items() if n]
    return run.spark.createDataFrame(counts, "table string, status string, rows bigint")


def match_stages(run: StageRun, t: dict[str, DataFrame], companies: list[str] | None = None, start: str | None = None,
                 skip: list[str] | None = None, limit: int | None = None) -> None:
    """K2 as stages ``matched``, ``untested`` and ``control``, of all companies or of some of those of the
    document headers.  A choice is made on the pivots, so everything after it, the control
    figures too, is of these companies; the figures are counted by the writes themselves."""
    spark, p = run.spark, run.p
    tagged, wanted = tag_headers(t, p), None
    if any(x is not None for x in (companies, start, skip, limit)):
        wanted = written(select_companies(header_companies(tagged), companies, start, skip, limit), "companies")
    pv = M.build_pivots(spark, t, p, tagged).only(wanted).write(run.path("pivots"))
    matched = run.put("matched", M.three_way_match(pv, p), observe=M.match_figures())
    run.put("untested", M.untested(pv, p))
    pv.release(remove=True)
    headers = t if wanted is None else {**t, **{h: tagged[h].join(wanted, "company", "left_semi") for h in ("VBAK", "LIKP", "VBRK")}}
    run.put("control", M.observed_control(spark, {**pv.figures, **matched}, M.source_totals(headers, p, t)), ())


def run_all(spark: SparkSession, t: dict[str, DataFrame], p: Params, out_dir: str | None = None,
            mode: str = "all", lists: bool = False, batch_id: str | None = None, companies: list[str] | None = None,
            start: str | None = None, skip: list[str] | None = None, limit: int | None = None, split: bool = False,
            malformed: dict[str, DataFrame] | None = None) -> StageRun:
    """K5: lists (optional) -> reconcile -> analyse -> group report.

    mode="all" runs every stage; "diff-only" starts from the match stages of the
    run published last (of this batch); "match+diff" skips the lists.  ``companies``,
    ``start``, ``skip`` and ``limit`` select companies among those of the document headers
    (B39); everything, the control figures too, is then of these companies only.
    ``split`` also writes the tables by company (A10-A12); ``malformed`` are the
    rows that the extract reader dropped (A5), counted by table.

    The document pivots are written once, bucketed on the match key, and read by
    the match and the untested classes.  Nothing is visible to readers before the
    last stage is written (:mod:`.stages`).  Returns the published run.
    """
    out_dir = out_dir or stage_dir(spark, "run")
    run = StageRun(spark, out_dir, p, batch_id)
    put, get = run.put, run.get

    if lists and mode == "all":
        for name, df in build_lists(spark, t, p).items():
            put(name, df.withColumnRenamed("sales_org", "company") if p.company_by == "vkorg" else df, ())
    if malformed is not None:
        put("malformed_rows", R.malformed_rows(malformed), ())
    if mode in ("all", "match+diff"):
        match_stages(run, t, companies, start, skip, limit)
        if split:
            put("split_rows", write_split(run, t, p), ())
    else:
        before = open_run(spark, out_dir, p, batch_id)
        run.stages |= {k: v for k, v in before.stages.items() if k in ("matched", "untested", "control")}
    matched, open_rows = get("matched"), get("untested")
    an = analyse(None, p, matched=matched, untested=open_rows)
    put("classified", an.classified)
    put("stats", an.stats)
    detail_rows = S.detail(get("classified"))
    put("detail", detail_rows)
    put("scenario_extract", scenario_extract(detail_rows), ("scenario",))
    excl = exclusion_set(spark, p, t["VBAK"], t["VBRK"])
    put("untested_summary", R.untested_summary(open_rows, t["VBAK"], excl, p), ())
    put("missing_invoice", R.missing_invoice_amount(open_rows), ())
    put("verify", V.verify_lookup(get("detail"), t, p), ())
    put("verify_summary", V.verify_summary(get("verify")), ())
    rep = group_report(spark, get("stats"), p)
    for name in REPORTS:
        put(f"report_{name}", getattr(rep, name), ())
    return run.publish()


__all__ = ["Analysis", "GroupReport", "Reconciled", "StageRun", "analyse", "build_lists", "group_report", "open_run", "read_stage",
           "match_stages", "reconcile", "reconcile_figures", "reconcile_stored", "reconciled", "run_all", "scenario_extract", "stage_invoice_lines", "write_split", "write_stage"]
