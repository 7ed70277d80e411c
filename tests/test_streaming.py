"""Incremental ingest with a file-source stream and availableNow."""

from __future__ import annotations

import tempfile

from triad.streaming.ingest import ingest_stream, read_ingested, read_settled, settle

HDR = "MANDT#|#VBELN#|#VKORG#|#NETWR#|#AUDAT"


def _part(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([HDR] + rows) + "\n")


def test_ingest_runs_are_incremental(spark):
    base = tempfile.mkdtemp(prefix="triad-stream-")
    landing, out, ckpt = f"{base}/landing", f"{base}/vbak", f"{base}/ckpt"
    import os
    os.makedirs(landing)
    _part(f"{landing}/VBAK_1.TXT", ["100#|#0000000001#|#1000#|#10.00#|#20250101",
                                    "100#|#0000000002#|#2000#|#20.00#|#20250102#|#too-long"])
    _part(f"{landing}/VBAK_VBRP_1.TXT", ["100#|#9#|#9#|#9#|#9"])  # helper table: ignored
    q = ingest_stream(spark, landing, "VBAK", out, company_col="VKORG", checkpoint=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert [r["VBELN"] for r in first.collect()] == ["0000000001"]

    # a new part arrives; the next run takes only it
    _part(f"{landing}/VBAK_2.TXT", ["100#|#0000000003#|#2000#|#30.00#|#20250103"])
    q = ingest_stream(spark, landing, "VBAK", out, company_col="VKORG", checkpoint=ckpt)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert sorted(r["VBELN"] for r in df.collect()) == ["0000000001", "0000000003"]
    assert sorted(r["company"] for r in df.select("company").distinct().collect()) == ["1000", "2000"]
    # a rerun with nothing new adds nothing
    q = ingest_stream(spark, landing, "VBAK", out, company_col="VKORG", checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    assert str(df.where("VBELN = '0000000003'").collect()[0]["NETWR"]) == "30.00"


def test_ingest_line_table_company_from_headers(spark):
    import os
    base = tempfile.mkdtemp(prefix="triad-stream2-")
    landing, hdr_out, out = f"{base}/landing", f"{base}/vbak", f"{base}/vbap"
    os.makedirs(landing)
    _part(f"{landing}/VBAK_1.TXT", ["100#|#0000000001#|#1000#|#10.00#|#20250101"])
    with open(f"{landing}/VBAP_1.TXT", "w", encoding="utf-8") as f:
        f.write("MANDT#|#VBELN#|#POSNR#|#NETWR\n100#|#0000000001#|#000010#|#4.00\n100#|#0000000009#|#000010#|#1.00\n")
    ingest_stream(spark, landing, "VBAK", hdr_out, company_col="VKORG", checkpoint=f"{base}/c1").awaitTermination(120)
    ingest_stream(spark, landing, "VBAP", out, company_map=hdr_out, checkpoint=f"{base}/c2").awaitTermination(120)
    got = sorted((r["VBELN"], r["company"]) for r in spark.read.parquet(out).collect())
    assert got == [("0000000001", "1000"), ("0000000009", "UNMAPPED")]


def test_replayed_batch_and_second_layout(spark):
    """A batch whose commit was lost runs again without doubling rows, and a part
    with another column order is read by its own header."""
    import os
    base = tempfile.mkdtemp(prefix="triad-stream3-")
    landing, out, ckpt = f"{base}/landing", f"{base}/vbak", f"{base}/ckpt"
    os.makedirs(landing)
    _part(f"{landing}/VBAK_1.TXT", ["100#|#0000000001#|#1000#|#10.00#|#20250101"])
    with open(f"{landing}/VBAK_2.TXT", "w", encoding="utf-8") as f:
        f.write("VBELN#|#MANDT#|#NETWR#|#VKORG\n0000000002#|#100#|#20.00#|#2000\n")

    def run():
        ingest_stream(spark, landing, "VBAK", out, company_col="VKORG", checkpoint=ckpt).awaitTermination(120)

    def rows():
        return sorted((r["VBELN"], r["VKORG"], str(r["NETWR"]), r["company"]) for r in spark.read.parquet(out).collect())

    run()
    want = [("0000000001", "1000", "10.00", "1000"), ("0000000002", "2000", "20.00", "2000")]
    assert rows() == want
    for name in os.listdir(f"{ckpt}/commits"):  # the commit is lost, the batch stays planned
        if name.strip(".").split(".")[0] == "0":
            os.remove(f"{ckpt}/commits/{name}")
    run()
    assert rows() == want


def test_late_header_and_delivery_company(spark):
    import os
    base = tempfile.mkdtemp(prefix="triad-stream4-")
    landing = f"{base}/landing"
    os.makedirs(landing)

    def write(name, header, *lines):
        with open(f"{landing}/{name}", "w", encoding="utf-8") as f:
            f.write("\n".join(["#|#".join(header), *["#|#".join(x) for x in lines]]) + "\n")

    def run(table, **kw):
        ingest_stream(spark, landing, table, f"{base}/{table}", checkpoint=f"{base}/c-{table}", **kw).awaitTermination(120)

    write("VBAK_1.TXT", ["MANDT", "VBELN", "VKORG", "BUKRS_VF"], ["100", "1", "1000", "5001"])
    write("VBAP_1.TXT", ["MANDT", "VBELN", "POSNR"], ["100", "1", "10"], ["100", "2", "10"])
    write("VBRK_1.TXT", ["MANDT", "VBELN", "VKORG", "BUKRS"], ["100", "9", "2000", "5002"])
    write("LIKP_1.TXT", ["MANDT", "VBELN", "VKORG"], ["100", "7", "1000"], ["100", "8", "2000"], ["100", "6", "3000"])
    run("VBAK", company_col="BUKRS_VF")
    run("VBAP", company_map=f"{base}/VBAK")
    run("VBRK", company_col="BUKRS")
    run("LIKP")
    lines = lambda: sorted((r["VBELN"], r["company"]) for r in read_ingested(spark, f"{base}/VBAP", headers=f"{base}/VBAK").collect())
    settled = lambda t: sorted((r["VBELN"], r["company"]) for r in read_settled(spark, f"{base}/{t}").collect())
    assert lines() == [("1", "5001"), ("2", "UNMAPPED")] == settled("VBAP")
    assert settle(spark, f"{base}/VBAP", headers=f"{base}/VBAK") == 1
    assert settled("VBAP") == [("1", "5001"), ("2", "UNMAPPED")]
    write("VBAK_2.TXT", ["MANDT", "VBELN", "VKORG", "BUKRS_VF"], ["100", "2", "2000", "5002"])
    run("VBAK", company_col="BUKRS_VF")
    assert lines() == [("1", "5001"), ("2", "5002")]
    likp = read_ingested(spark, f"{base}/LIKP", vbak=f"{base}/VBAK", vbrk=f"{base}/VBRK")
    assert sorted((r["VBELN"], r["company"]) for r in likp.collect()) == [("6", "UNMAPPED"), ("7", "5001"), ("8", "5002")]
    # only the late line is joined with the headers; a second settling and a later batch change nothing settled
    for generation in (2, 3):
        assert settle(spark, f"{base}/VBAP", headers=f"{base}/VBAK") == generation
        assert settled("VBAP") == [("1", "5001"), ("2", "5002")]
    write("VBAP_2.TXT", ["MANDT", "VBELN", "POSNR"], ["100", "3", "10"], ["100", "1", "20"])
    run("VBAP", company_map=f"{base}/VBAK")
    assert settled("VBAP") == [("1", "5001"), ("1", "5001"), ("2", "5002"), ("3", "UNMAPPED")]
    settle(spark, f"{base}/LIKP", vbak=f"{base}/VBAK", vbrk=f"{base}/VBRK")
    assert settled("LIKP") == [("6", "UNMAPPED"), ("7", "5001"), ("8", "5002")]
    plan = read_settled(spark, f"{base}/VBAP")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_company_codes_are_text_in_any_session(spark):
    """A session that makes numbers of folder names: codes with a leading zero, and lines that are UNMAPPED."""
    import os
    base = tempfile.mkdtemp(prefix="triad-stream5-")
    os.makedirs(f"{base}/landing")
    for name, lines in (("VBAK", "MANDT#|#VBELN#|#VKORG#|#BUKRS_VF\n100#|#1#|#1000#|#0501\n"),
                        ("VBAP", "MANDT#|#VBELN#|#POSNR\n100#|#1#|#10\n100#|#2#|#10\n")):
        with open(f"{base}/landing/{name}_1.TXT", "w", encoding="utf-8") as f:
            f.write(lines)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        for table, how in (("VBAK", {"company_col": "BUKRS_VF"}), ("VBAP", {"company_map": f"{base}/VBAK"})):
            ingest_stream(spark, f"{base}/landing", table, f"{base}/{table}", checkpoint=f"{base}/c-{table}", **how).awaitTermination(120)
        assert settle(spark, f"{base}/VBAP", headers=f"{base}/VBAK") == 1
        want = [("1", "0501"), ("2", "UNMAPPED")]
        for df in (read_settled(spark, f"{base}/VBAP"), read_ingested(spark, f"{base}/VBAP", headers=f"{base}/VBAK")):
            assert sorted((r["VBELN"], r["company"]) for r in df.collect()) == want
        assert [r["company"] for r in read_ingested(spark, f"{base}/VBAK").collect()] == ["0501"]
    finally:
        spark.conf.set(key, before)
