"""Text extract source (A1–A8) and stage writes."""

from __future__ import annotations

import os
import tempfile

from conftest import SF_SMALL
from pyspark.sql import functions as F

from triad.config import fixture_params
from triad.plans import pipeline as PL
from triad.sources.extract import list_parts, read_table, write_extract
from triad.sources.fixtures import fixture_tables
from triad.sources.schema import column_default, column_type


def _write(path: str, lines: list[str], encoding: str = "utf-8") -> None:
    with open(path, "w", encoding=encoding) as f:
        f.write("\n".join(lines) + "\n")


def test_extract_parts_headers_and_malformed(spark):
    d = tempfile.mkdtemp(prefix="triad-ext-")
    # part 1: normal order, one too-long row (dropped, counted), one short row (kept, padded)
    _write(f"{d}/VBAK_1.TXT", [
        " mandt #|#VBELN#|#VKORG#|#NETWR#|#AUDAT",
        "100#|#0000000001#|#1000#|#12.50#|#20250105",
        "100#|#0000000002#|#1000#|#7.25#|#20250106#|#extra",
        "100#|#0000000003#|#2000",
    ])
    # part 2: different header order and an extra non-field column name
    _write(f"{d}/VBAK_2.TXT", [
        "VBELN#|#MANDT#|#NETWR#|#VKORG#|#AUDAT#|#bad-name",
        "0000000004#|#100#|#abc#|#3000#|#2025-01-01#|#z",
    ])
    # helper table sharing the prefix: must not be read
    _write(f"{d}/VBAK_VBRP_1.TXT", ["VBELN#|#X", "9#|#9"])
    parts = list_parts(spark, d, "VBAK")
    assert [os.path.basename(p) for p in parts] == ["VBAK_1.TXT", "VBAK_2.TXT"]
    r = read_table(spark, d, "VBAK")
    rows = {x["VBELN"]: x for x in r.df.collect()}
    assert sorted(rows) == ["0000000001", "0000000003", "0000000004"]
    assert r.dropped.count() == 1
    assert str(rows["0000000001"]["NETWR"]) == "12.50"
    assert str(rows["0000000001"]["AUDAT"]) == "2025-01-05"
    assert rows["0000000003"]["NETWR"] == 0 and rows["0000000003"]["AUDAT"] is None
    # unparsable amount -> 0, ISO date text is not a yyyymmdd date -> null
    assert rows["0000000004"]["NETWR"] == 0 and rows["0000000004"]["AUDAT"] is None
    assert rows["0000000004"]["VKORG"] == "3000"


def test_extract_gbk(spark):
    d = tempfile.mkdtemp(prefix="triad-gbk-")
    _write(f"{d}/VBAP_1.TXT", ["MANDT#|#VBELN#|#POSNR#|#ARKTX", "100#|#0000000001#|#000010#|#螺丝"], encoding="gbk")
    r = read_table(spark, d, "VBAP", encoding="GBK")
    assert r.df.collect()[0]["ARKTX"] == "螺丝"


def test_round_trip_fixture(spark):
    t = fixture_tables(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="triad-rt-")
    for table in ("VBAK", "LIPS", "VBRP"):
        src = t[table]
        write_extract(src, f"{d}/{table.lower()}")
        # rename Spark's part files to the extract naming pattern
        outs = sorted(f for f in os.listdir(f"{d}/{table.lower()}") if f.startswith("part-"))
        for i, f in enumerate(outs):
            os.rename(f"{d}/{table.lower()}/{f}", f"{d}/{table}_{i + 1}.TXT")
        back = read_table(spark, d, table).df
        cols = [c for c in src.columns if c != "_ord"]
        # the text format cannot tell a null string from '' (compare blanks as
        # null), and an absent column is null where an empty cell of a
        # present column gets the loader default (compare with defaults)
        def norm_col(c):
            v = F.when(F.col(c).cast("string") == "", None).otherwise(F.col(c))
            dflt = column_default(c)
            return (v if dflt is None else F.coalesce(v, F.lit(dflt).cast(column_type(c)))).alias(c)
        norm = [norm_col(c) for c in cols]
        a, b = src.select(*norm), back.select(*norm)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stage_write_append_batches(spark):
    p = fixture_params().with_(rows_per_file=2)
    d = tempfile.mkdtemp(prefix="triad-stage-") + "/s"
    df = spark.createDataFrame([("1000", i) for i in range(5)] + [("2000", 9)], "company string, v int")
    PL.write_stage(df, d, p, batch_id="b1")
    PL.write_stage(df.where("v < 2"), d, p, append=True, batch_id="b2")
    # At most 2 rows per file
    files = [f for _, _, fs in os.walk(d) for f in fs if f.endswith(".parquet")]
    assert len(files) >= 4
    allrows = PL.read_stage(spark, d)
    assert allrows.count() == 8
    assert [r["batch_id"] for r in PL.read_stage(spark, d, batch_id="b2").collect()] == ["b2", "b2"]
    newest = PL.read_stage(spark, d, newest_batch=True)
    assert sorted(r["v"] for r in newest.collect()) == [0, 1]
    # company codes stay text (leading zeros would survive)
    assert dict(allrows.dtypes)["company"] == "string"


def test_small_files_are_written_by_all_tasks(spark, monkeypatch):
    """one folder of many small files is no single task, and every row is written."""
    from triad.plans import stages as ST
    monkeypatch.setattr(ST, "FILES_A_TASK", 5)
    p = fixture_params().with_(rows_per_file=2)
    df = spark.range(400).select(F.lit("0100").alias("company"), F.col("id").alias("v"))
    d = tempfile.mkdtemp(prefix="triad-stage-") + "/s"
    PL.write_stage(df, d, p)
    back = PL.read_stage(spark, d)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    files = [f for _, _, fs in os.walk(d) for f in fs if f.endswith(".parquet")]
    assert len({f.split("-")[1] for f in files}) == 4 and 200 <= len(files) <= 204


def test_period_is_pushed_into_the_staged_extract(spark):
    """The typed stage is reused, and the invoice period reaches its scan."""
    from triad.operators.invoices import _period_lines
    t = fixture_tables(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="triad-push-")
    for table in ("VBRK", "VBRP"):
        write_extract(t[table], f"{d}/{table.lower()}")
        for i, f in enumerate(sorted(f for f in os.listdir(f"{d}/{table.lower()}") if f.startswith("part-"))):
            os.rename(f"{d}/{table.lower()}/{f}", f"{d}/{table}_{i + 1}.TXT")
    read = {n: read_table(spark, d, n).df for n in ("VBRK", "VBRP")}
    again = read_table(spark, d, "VBRP").df
    assert sorted(again.inputFiles()) == sorted(read["VBRP"].inputFiles())
    plan = _period_lines(read["VBRK"], read["VBRP"], fixture_params())._jdf.queryExecution().executedPlan().toString()
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x and "FKDAT" in x.split("PushedFilters")[1]]
    assert pushed, plan
