"""Benchmark: the three pipeline stages at one scale factor.

  stage     - derive the six SAP-shaped tables from the star schema and write
              them as Parquet (the staged extract every run starts from);
              timed once, not part of the headline value;
  reconcile - document pivots written once, match + untested classes from them,
              written as company-partitioned Parquet;
  analyse   - scenarios + statistics from the written match stage, written;
  group_report - the group report from the written statistics, collected;
  lists     - the three lists, written.
``exchanges`` counts the hash exchanges in the plans of the four pivots, the match
and the untested classes.  Each of reconcile / analyse / group_report / lists is run 3 times warm and the
median reported.  Prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from triad.config import fixture_params  # noqa: E402
from triad.operators import matching as M  # noqa: E402
from triad.plans import pipeline as PL  # noqa: E402
from triad.session import build_session  # noqa: E402
from triad.sources.fixtures import fixture_tables  # noqa: E402
from triad.config import TABLES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="triad-bench-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    p = fixture_params()

    t0 = time.time()
    src = fixture_tables(spark, sf_dir)
    staged = os.path.join(scratch, "staged")
    for name in TABLES:
        src[name].write.mode("overwrite").parquet(os.path.join(staged, name))
    t_stage = time.time() - t0
    t = {name: spark.read.parquet(os.path.join(staged, name)) for name in TABLES}

    def reconcile(i):
        out = os.path.join(scratch, f"run{i}")
        pv = M.build_pivots(spark, t, p).write(os.path.join(out, "pivots"))
        PL.write_stage(M.three_way_match(pv, p), os.path.join(out, "matched"), p)
        PL.write_stage(M.untested(pv, p), os.path.join(out, "untested"), p)
        return out

    def exchanges():
        built = M.build_pivots(spark, t, p)
        pv = built.write(os.path.join(scratch, "plans"))
        frames = {**{n: getattr(built, n) for n in M.Pivots.NAMES}, "match": M.three_way_match(pv, p), "untested": M.untested(pv, p)}
        plans = {k: df._jdf.queryExecution().executedPlan().toString() for k, df in frames.items()}
        return {k: plan.count("Exchange hashpartitioning") for k, plan in plans.items()}

    def analyse(out):
        matched = spark.read.parquet(os.path.join(out, "matched"))
        untested = spark.read.parquet(os.path.join(out, "untested"))
        an = PL.analyse(None, p, main=M.main_rows(matched), negative=M.negative_invoices(matched), untested=untested)
        PL.write_stage(an.classified, os.path.join(out, "classified"), p)
        PL.write_stage(an.stats, os.path.join(out, "stats"), p)

    def report(out):
        stats = spark.read.parquet(os.path.join(out, "stats"))
        rep = PL.group_report(spark, stats, p)
        for name in ("scenarios", "table", "classes", "rates", "tiers", "overall", "sensitivity", "internal_only"):
            getattr(rep, name).collect()

    def lists(i):
        for name, df in PL.build_lists(spark, t, p).items():
            PL.write_stage(df, os.path.join(scratch, f"lists{i}", name), p, partition_by=())

    times = {"reconcile": [], "analyse": [], "group_report": [], "lists": []}
    for i in range(4):  # run 0 warms up the JVM and caches; 1..3 are measured
        a = time.time()
        out = reconcile(i)
        b = time.time()
        analyse(out)
        c = time.time()
        report(out)
        d = time.time()
        lists(i)
        e = time.time()
        if i:
            times["reconcile"].append(b - a)
            times["analyse"].append(c - b)
            times["group_report"].append(d - c)
            times["lists"].append(e - d)
    q = {k: round(statistics.median(v), 3) for k, v in times.items()}
    q["stage_extract_once"] = round(t_stage, 3)
    total = round(q["reconcile"] + q["analyse"] + q["group_report"], 3)
    print(json.dumps({"metric": "reconcile+analyse+group_report (median of 3, warm)", "value": total,
                      "unit": "sec", "queries": q, "exchanges": exchanges(), "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
