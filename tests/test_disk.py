"""What a run leaves on disk behind itself: no shuffle files, no rows that nothing reads any more."""

from __future__ import annotations

import os
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from triad.config import fixture_params
from triad.operators import matching as M
from triad.plans import catalog
from triad.plans import pipeline as PL
from triad.plans import roundtrips as RT
from triad.plans import stages as ST
from triad.session import SHUFFLE_CLEANUP, stage_dir, written
from triad.sources.fixtures import fixture_tables


def shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def left_by(spark, run) -> set[str]:
    """Shuffle files that ``run`` leaves; what it returns is kept meanwhile."""
    before, kept = shuffle_files(spark), run()
    for _ in range(50):  # they go a little after the write
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    del kept
    return new


@pytest.fixture(scope="module")
def ctx(spark):
    return catalog.Ctx(spark, SF_SMALL)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).withColumn("company", (F.col("id") % 7).cast("string"))


@pytest.mark.parametrize("write", ["written", "stage", "run"])
def test_a_write_leaves_no_shuffle_files(spark, rows, tmp_path, write):
    d, p = rows.groupBy("company").agg(F.sum("id").alias("n")), fixture_params()
    how = {"written": lambda: written(d, "x"), "stage": lambda: PL.write_stage(d, str(tmp_path), p),
           "run": lambda: ST.StageRun(spark, str(tmp_path), p).put("x", d)}
    was = spark.conf.get(SHUFFLE_CLEANUP)
    assert left_by(spark, how[write]) == set()
    assert spark.conf.get(SHUFFLE_CLEANUP) == was  # the session's own


def test_pivots_leave_no_shuffle_files_and_only_themselves(spark, ctx, tmp_path):
    scratch = stage_dir(spark, "scratch")
    had = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    got = []
    new = left_by(spark, lambda: got.append(M.build_pivots(spark, ctx.t, ctx.p).write(str(tmp_path / "pivots"))))
    assert new == set()
    assert set(os.listdir(scratch)) == had                      # delivery lines, order lines, grain
    assert sorted(os.listdir(tmp_path / "pivots")) == ["delivery", "grain", "invoice"]
    got[0].release(remove=True)
    assert os.listdir(tmp_path / "pivots") == []


def test_written_pivots_are_the_pivots(spark, ctx, tmp_path):
    """Types and descriptions too, where an order line has several rows, materials or no type."""
    for figures in (False, True):
        pv = M.build_pivots(spark, _untidy(ctx.t), ctx.p)
        pv = pv.figures_only() if figures else pv
        want = {n: sorted(map(str, getattr(pv, n).collect())) for n in pv.NAMES}
        kept = pv.write(str(tmp_path / f"pivots{figures}"), control=False)
        for n in pv.NAMES:
            assert getattr(kept, n).dtypes == getattr(pv, n).dtypes
            assert sorted(map(str, getattr(kept, n).collect())) == want[n], n
        kept.release()


def _untidy(t):
    """Every third order without a type; every order line once more with another material."""
    again = t["VBAP"].withColumn("MATNR", F.concat(F.lit("Z"), "MATNR")).withColumn("_ord", F.col("_ord").withField("MATNR", F.lit("Z")))
    return {**t, "VBAP": t["VBAP"].unionByName(again),
            "VBAK": t["VBAK"].withColumn("AUART", F.when(F.col("VBELN").cast("bigint") % 3 > 0, F.col("AUART")))}


def test_a_stored_match_keeps_its_stages_only(spark, ctx):
    d = RT.stored_match(ctx, "disk")
    assert sorted(n for n in os.listdir(d) if n != "pivots") == ["matched", "untested"]
    assert os.listdir(f"{d}/pivots") == []


@pytest.mark.parametrize("name", ["c9_match_all_dates", "c14_verify_lookup_all_dates", "d16_tier_summary_all_dates", "f6_ordered_output"])
def test_the_match_is_read_from_written_pivots(spark, name):
    """Documents are not joined in the query that returns the match: all their shuffles would lie side by side."""
    plan = catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan


def test_a_split_leaves_no_shuffle_files(spark, tmp_path):
    p = fixture_params().with_(company_by="bukrs")
    t = fixture_tables(spark, SF_SMALL)
    run = ST.StageRun(spark, str(tmp_path), p)
    assert left_by(spark, lambda: PL.write_split(run, t, p)) == set()
