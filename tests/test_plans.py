"""Plan shape and whole-run invariants on the sf0.001 fixture."""

from __future__ import annotations

import os
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from triad.config import fixture_params
from triad.operators import matching as M
from triad.plans import pipeline as PL
from triad.sources.fixtures import FIXTURE_VIEWS, fixture_tables

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.fixture(scope="module")
def run(spark):
    p = fixture_params()
    t = fixture_tables(spark, SF_SMALL)
    rec = PL.reconcile(spark, t, p)
    an = PL.analyse(rec, p)
    rep = PL.group_report(spark, an.stats, p)
    return p, t, rec, an, rep


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_python_in_plans(run):
    _, _, rec, an, rep = run
    for df in (rec.matched, rec.untested, an.classified, an.stats, rep.table, rep.rates, rep.tiers):
        plan = _plan(df)
        for bad in FORBIDDEN:
            assert bad not in plan, bad


def test_scans_prune_columns_and_push_filters(run):
    _, _, rec, _, _ = run
    plan = rec.pivots.invoice._jdf.queryExecution().executedPlan().toString()
    # the star-schema scan reads only the columns the fixture needs
    assert "ReadSchema" in plan
    li = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert li and all("l_comment" not in ln for ln in li)


def test_every_match_row_in_exactly_one_class(run):
    _, _, rec, an, _ = run
    n_match = rec.matched.count()
    n_neg = rec.negative.count()
    n_cls = an.classified.count()
    assert n_match == n_neg + n_cls
    allowed = {0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13}
    assert {r[0] for r in an.classified.select("scenario").distinct().collect()} <= allowed


def test_untested_disjoint_from_invoices(run):
    _, _, rec, _, _ = run
    keys = ["VKORG", "VBELN", "POSNR"]
    assert rec.untested.join(rec.pivots.invoice.select(*keys), keys, "left_semi").count() == 0
    classes = {r[0] for r in rec.untested.select("class").distinct().collect()}
    assert classes <= {"order_only", "order_delivery", "delivery_only"}


def test_stats_rows_equal_detail_counts(run):
    _, _, rec, an, _ = run
    by_s = {r["scenario"]: r["count"] for r in an.classified.groupBy("scenario").count().collect()}
    for r in an.stats.groupBy("scenario").agg(F.sum("rows").alias("rows")).collect():
        s = r["scenario"]
        if s == 7:
            exp = rec.untested.where(F.col("class").isin("order_only", "order_delivery")).count()
        elif s == 14:
            exp = rec.negative.count()
        else:
            exp = by_s.get(s, 0)
        assert r["rows"] == exp, s


def test_group_totals_equal_sum_of_companies(run):
    _, _, _, an, rep = run
    per = an.stats.groupBy("scenario").agg(F.sum("rows").alias("r"), F.sum("inv_amt").alias("a"))
    grp = rep.scenarios
    cols = grp.columns
    rcol = "rows" if "rows" in cols else cols[1]
    j = per.join(grp, "scenario")
    assert j.where(F.col("r") != F.col(rcol)).count() == 0


def test_invoice_control_total(run):
    _, _, rec, _, _ = run
    c = rec.control().collect()[0]
    assert c["fan_out"] == 0
    inv = rec.pivots.invoice.agg(F.sum("inv_amt")).collect()[0][0]
    assert float(inv) == pytest.approx(c["invoice_total"])


def test_run_all_writes_and_reads_back(spark, run, tmp_path):
    p, t, rec, an, _ = run
    bad = spark.createDataFrame([("VBAK", "f", "x"), ("VBAK", "f", "y")], "table string, _src_file string, line string")
    done = PL.run_all(spark, t, p, out_dir=str(tmp_path / "run"), lists=True, malformed={"VBAK": bad, "VBAP": bad.limit(0)})
    stats = done.get("stats")
    a = stats.select("company", "scenario", "rows").exceptAll(an.stats.select("company", "scenario", "rows"))
    assert a.count() == 0
    assert spark.read.parquet(done["report_table"]).count() > 0
    assert {r["table"]: r["rows"] for r in done.get("malformed_rows").collect()} == {"VBAK": 2, "VBAP": 0}
    # counted by the writes = counted by a query
    observed, counted = done.get("control").first().asDict(), rec.control().first().asDict()
    assert {k: observed[k] for k in counted} == counted


def test_exchange_counts(run, spark, tmp_path):
    """With the pivots written in buckets, neither the match nor the untested classes shuffle."""
    from triad.operators import matching as M
    p, t, _, _, _ = run
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pv = M.build_pivots(spark, t, p).write(str(tmp_path / "pivots"))
        plans = {n: _plan(df) for n, df in (("match", M.three_way_match(pv, p)), ("untested", M.untested(pv, p)))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plans["match"].count("Exchange") == plans["untested"].count("Exchange") == 0
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in ("grain", "delivery", "invoice"):
        assert len([f for f in os.listdir(tmp_path / "pivots" / n) if f.endswith(".parquet")]) <= buckets
    pv.release()


def test_statistics_read_the_match_once(spark):
    t = fixture_tables(spark, SF_SMALL)
    rec = PL.reconcile(spark, t, fixture_params())
    rec.matched = rec.matched.checkpoint()
    open_rows = rec.untested.checkpoint()
    whole = PL.analyse(None, fixture_params(), matched=rec.matched, untested=open_rows).stats
    parts = PL.analyse(None, fixture_params(), main=M.main_rows(rec.matched), negative=M.negative_invoices(rec.matched), untested=open_rows).stats
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2          # the match and the untested rows


def test_statistics_read_the_documents_once(spark, run):
    """The match and the untested rows behind the statistics share written pivots."""
    p, t, _, an, _ = run
    rec = PL.reconcile_figures(spark, t, p)
    stats = PL.analyse(rec, p).stats
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, an.stats.collect()))
    assert "lineitem" not in stats._jdf.queryExecution().optimizedPlan().toString()
    folded = [ln for ln in stats._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [company" in ln]
    assert any("scenario" in ln.split("]")[0] for ln in folded)   # few sums a row, by company and scenario
    rec.pivots.release()


def test_header_views_join_one_row_an_order(spark, run):
    _, t, _, _, _ = run
    for h in ("LIKP", "VBRK"):
        as_written = spark.sql(dict(FIXTURE_VIEWS)[h.lower()])
        rows = t[h].select("VBELN", "VKORG")
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, as_written.select("VBELN", "VKORG").collect()))
        assert re.search(r"Aggregate \[(lk|l_orderkey)#\d+L\]", t[h]._jdf.queryExecution().optimizedPlan().toString())
