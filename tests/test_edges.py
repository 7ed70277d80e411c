"""Hand-made edge rows (FIXTURES.md §5): cases the star-schema fixture
cannot reach, checked end to end through reconcile + analyse."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import doc_set, edge_params, make_tables, merge_sets
from pyspark.sql import functions as F

from triad.functions import exprs as X
from triad.operators import deliveries as DV
from triad.operators import matching as M
from triad.operators import report as R
from triad.plans import pipeline as PL


def _run(spark, rows, p=None):
    p = p or edge_params()
    t = make_tables(spark, **rows)
    rec = PL.reconcile(spark, t, p)
    an = PL.analyse(rec, p)
    return t, rec, an


def _scenarios(an) -> dict[str, int]:
    return {r["VBELN"]: r["scenario"] for r in an.classified.select("VBELN", "scenario").collect()}


def test_amount_tolerance_boundary(spark):
    rows = merge_sets(
        doc_set(1, ord_amt="100.00", inv_amt="100.00"),   # equal -> 10
        doc_set(2, ord_amt="100.01", inv_amt="100.00"),   # exactly +t -> 0
        doc_set(3, ord_amt="100.00", inv_amt="100.02"),   # order lower by 0.02 -> 8
        doc_set(4, ord_amt="100.02", inv_amt="100.00"),   # order higher -> 9
    )
    _, _, an = _run(spark, rows)
    s = _scenarios(an)
    assert s == {"0000000001": 10, "0000000002": 0, "0000000003": 8, "0000000004": 9}
    # scenario 0 counted in the row total but not in the detail
    assert an.detail.where("scenario = 0").count() == 0


def test_truth_table(spark):
    # (order, delivery, invoice qty; order, invoice amount) -> scenario
    cases = {
        5: ("10", "12", "10", "100.00", "101.00", 1),
        6: ("10", "12", "10", "101.00", "100.00", 2),
        7: ("10", "12", "10", "100.00", "100.00", 3),
        8: ("10", "12", "11", "100.00", "101.00", 4),
        9: ("10", "12", "11", "101.00", "100.00", 5),
        10: ("10", "12", "11", "100.00", "100.00", 6),
        11: ("10", "10", "11", "100.00", "100.00", 11),
        12: ("10", "10", "11", "100.00", "101.00", 12),
        13: ("10", "10", "11", "101.00", "100.00", 13),
    }
    rows = merge_sets(*[doc_set(n, ord_qty=o, dlv_qty=d, inv_qty=i, ord_amt=a, inv_amt=b)
                        for n, (o, d, i, a, b, _) in cases.items()])
    _, _, an = _run(spark, rows)
    s = _scenarios(an)
    assert s == {f"{n:010d}": exp for n, (*_, exp) in cases.items()}


def test_unit_fix_zero_order_qty(spark):
    rows = doc_set(20, ord_qty="0", dlv_qty="4", inv_qty="0")
    _, _, an = _run(spark, rows)
    r = an.classified.collect()[0]
    assert r["scenario"] == 10 and r["unit_fix"] is True
    assert r["dlv_qty_raw"] == Decimal("4.00") and r["dlv_qty"] == Decimal("0.00")


@pytest.mark.parametrize("dlv,fires", [("3950", False), ("3951", True), ("4050", False)])
def test_unit_fix_ratio_exact(spark, dlv, fires):
    rows = doc_set(21, ord_qty="1000", dlv_qty=dlv, inv_qty="1000")
    _, _, an = _run(spark, rows)
    r = an.classified.collect()[0]
    assert r["unit_fix"] is fires
    assert r["scenario"] == (10 if fires else 3)


def test_invoice_key_falls_back_as_a_pair(spark):
    # AUBEL set but AUPOS blank: both parts come from VBELV/POSNV (a delivery
    # number), so the invoice is keyed by the delivery and finds no order.
    rows = doc_set(30, vbrp_AUPOS="", vbrp_POSNV="000020")
    _, rec, _ = _run(spark, rows)
    keys = [(r["VBELN"], r["POSNR"]) for r in rec.pivots.invoice.collect()]
    assert keys == [("8000000030", "000020")]
    m = rec.matched.collect()[0]
    assert m["order_missing"] is True


def test_ten_zero_reference_is_not_blank(spark):
    df = spark.createDataFrame([("0000000000",), ("000000",), (" nan ",), (None,), ("0",), ("000",)], "v string")
    got = [r[0] for r in df.select(X.blank_ref("v")).collect()]
    assert got == [False, True, True, True, True, True]


def test_missing_header_vkorg(spark):
    # header rows absent: order row kept with VKORG ''; delivery and invoice
    # rows fall out of their pivots (null VKORG).
    rows = doc_set(40)
    rows = {k: v for k, v in rows.items() if k not in ("vbak", "likp", "vbrk")}
    _, rec, _ = _run(spark, rows)
    ordp = rec.pivots.order.collect()
    assert len(ordp) == 1 and ordp[0]["VKORG"] == ""
    assert rec.pivots.delivery.count() == 0
    assert rec.pivots.invoice.count() == 0


def test_umvkz_zero(spark):
    # order: KLMENG missing, UMVKZ 0 -> base qty 0; delivery: LGMNG missing,
    # UMVKZ 0 -> factor read as 1.
    rows = doc_set(50, vbap_KLMENG=None, vbap_UMVKZ="0", lips_LGMNG=None, lips_UMVKZ="0", dlv_qty="7")
    _, rec, _ = _run(spark, rows)
    assert rec.pivots.order.collect()[0]["ord_qty"] == 0
    assert rec.pivots.delivery.collect()[0]["dlv_qty"] == Decimal("7")


def _lips(n, pos, lfimg, uepos="000000", uecha="000000"):
    return {"MANDT": "100", "VBELN": f"8{n:09d}", "POSNR": pos, "UEPOS": uepos, "UECHA": uecha,
            "VBELV": f"{n:010d}", "POSNV": "000010", "VGBEL": f"{n:010d}", "VGPOS": "000010",
            "LFIMG": lfimg, "LGMNG": lfimg, "UMVKZ": "1", "UMVKN": "1"}


def test_batch_children(spark):
    p = edge_params()
    lips = [
        # delivery 60: parent with zero quantity -> its child is kept
        _lips(60, "000010", "0"), _lips(60, "900001", "5", uepos="000010"),
        # delivery 61: parent with quantity, children by UEPOS and by UECHA -> dropped
        _lips(61, "000010", "5"), _lips(61, "900001", "2", uepos="000010"), _lips(61, "900002", "3", uecha="000010"),
        # delivery 62: child whose parent is absent -> kept
        _lips(62, "900001", "4", uepos="000010"),
    ]
    likp = [{"MANDT": "100", "VBELN": f"8{n:09d}", "VKORG": "1000"} for n in (60, 61, 62)]
    vbak = [{"MANDT": "100", "VBELN": f"{n:010d}", "VKORG": "1000"} for n in (60, 61, 62)]
    t = make_tables(spark, lips=lips, likp=likp, vbak=vbak)
    lines = DV.delivery_lines(t["LIKP"], t["LIPS"], DV.known_orders(t["VBAK"]), p, batch_dedup=True)
    got = sorted((r["VBELN"][-2:], r["POSNR"]) for r in lines.select("VBELN", "POSNR").collect())
    assert got == [("60", "900001"), ("61", "000010"), ("62", "900001")]


def test_sign_and_sold_to(spark):
    df = spark.createDataFrame([("h", "000004390"), (" x ", "4390"), (None, "0000"), ("Z", "")], "s string, k string")
    got = [(r[0], r[1]) for r in df.select(X.sign("s"), X.sold_to_norm("k")).collect()]
    assert got == [(-1, "4390"), (-1, "4390"), (1, "0"), (1, "0")]


def test_intercompany_excluded(spark):
    rows = merge_sets(doc_set(70, vbak_KUNNR="000004390", vbrk_KUNAG="4390"), doc_set(71))
    _, rec, _ = _run(spark, rows)
    # the invoice pivot is keyed by the order it points to (AUBEL)
    assert [r["VBELN"] for r in rec.pivots.invoice.collect()] == ["0000000071"]
    assert [r["VBELN"] for r in rec.pivots.order.collect()] == ["0000000071"]


def test_negative_invoice_split(spark):
    rows = merge_sets(
        doc_set(80, ord_qty="0", dlv_qty="0", inv_qty="-1", inv_amt="-50.00"),
        doc_set(81),
    )
    _, rec, an = _run(spark, rows)
    assert [r["VBELN"] for r in rec.negative.collect()] == ["0000000080"]
    st = {r["scenario"]: r["rows"] for r in an.stats.where("rows > 0").collect()}
    assert st == {10: 1, 14: 1}


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(Decimal("0.125"),), (Decimal("0.135"),)], "v decimal(18,3)")
    assert [r[0] for r in df.select(X.round2("v")).collect()] == [Decimal("0.12"), Decimal("0.14")]


def test_untested_classes_disjoint(spark):
    rows = merge_sets(
        doc_set(90),                                       # invoiced -> tested
        {k: v for k, v in doc_set(91).items() if k not in ("vbrk", "vbrp")},  # order + delivery
        {k: v for k, v in doc_set(92).items() if k in ("vbak", "vbap")},      # order only
    )
    _, rec, _ = _run(spark, rows)
    got = sorted((r["VBELN"], r["class"]) for r in rec.untested.collect())
    assert got == [("0000000091", "order_delivery"), ("0000000092", "order_only")]
    assert rec.matched.count() == 1


def test_control_totals(spark):
    rows = merge_sets(doc_set(100), doc_set(101, inv_amt="55.55"))
    _, rec, _ = _run(spark, rows)
    c = rec.control().collect()[0]
    assert c["rows_out"] == 2 and c["fan_out"] == 0 and c["invoice_total"] == pytest.approx(155.55)


def test_duplicate_delivery_header_kept_first(spark):
    rows = doc_set(110)
    rows["likp"] = rows["likp"] + [dict(rows["likp"][0], VKORG="2000")]
    _, rec, _ = _run(spark, rows)
    assert [r["VKORG"] for r in rec.pivots.delivery.collect()] == ["1000"]


def test_order_pivot_material_grain(spark):
    rows = doc_set(120)
    rows["vbap"] = rows["vbap"] + [dict(rows["vbap"][0], MATNR="M2", NETWR="50.00", KLMENG="5", KWMENG="5")]
    _, rec, _ = _run(spark, rows)
    assert rec.pivots.order.count() == 2
    k = rec.pivots.order_key.collect()[0]
    assert k["ord_qty"] == Decimal("15") and k["MATNR"] == "M1" and k["n_materials"] == 2
    assert rec.matched.where(F.col("VBELN") == "0000000120").count() == 1
    assert M.MATCH_MEASURES


def test_company_by_bukrs(spark):
    # company code through the VKORG->BUKRS map (VBRK last wins over VBAK)
    rows = merge_sets(doc_set(130, vbak_BUKRS_VF="5001"), doc_set(131, vkorg="2000"))
    _, rec, an = _run(spark, rows, edge_params(company_by="bukrs"))
    got = sorted((r["VBELN"], r["company"]) for r in rec.matched.collect())
    assert got == [("0000000130", "5000"), ("0000000131", "5000")]
    assert {r["company"] for r in an.stats.where("rows > 0").collect()} == {"5000"}


def test_empty_reference_never_matches(spark):
    # an order header with an empty number must not pull in every delivery
    # line with an empty reference (empty keys are salted, never joined)
    p = edge_params()
    vbak = [{"MANDT": "100", "VBELN": "", "VKORG": "1000"}, {"MANDT": "100", "VBELN": "0000000140", "VKORG": "1000"}]
    likp = [{"MANDT": "100", "VBELN": "8000000140", "VKORG": "1000"}]
    lips = [_lips(140, "000010", "5"),
            dict(_lips(140, "000020", "5"), VBELV="", VGBEL=""),
            dict(_lips(140, "000030", "5"), VBELV="", VGBEL="0000000140")]
    t = make_tables(spark, vbak=vbak, likp=likp, lips=lips)
    lines = DV.delivery_lines(t["LIKP"], t["LIPS"], DV.known_orders(t["VBAK"]), p, batch_dedup=True)
    assert sorted(r["POSNR"] for r in lines.collect()) == ["000010", "000030"]


def test_company_of_each_header(spark):
    """One sales organisation, two companies: rows go where their headers say,
    and an order of another company is not known to a delivery."""
    rows = merge_sets(doc_set(150, vbak_BUKRS_VF="5001", vbrk_BUKRS="5001"), doc_set(151, vbak_BUKRS_VF="5002", vbrk_BUKRS="5002"),
                      doc_set(152, vbak_BUKRS_VF="5001", vbrk_BUKRS="5002"))
    _, rec, an = _run(spark, rows, edge_params(company_by="bukrs"))
    got = {r["VBELN"][-3:]: (r["company"], r["order_missing"], r["delivery_missing"]) for r in rec.matched.collect()}
    # the map gives VKORG 1000 to the company of the last invoice header, 5002
    assert got == {"150": ("5001", False, True), "151": ("5002", False, False), "152": ("5002", True, True)}
    left = sorted((r["VBELN"][-3:], r["company"], r["class"]) for r in rec.untested.collect())
    assert left == [("152", "5001", "order_only")]
    for df in (rec.matched, rec.untested):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(VKORG" not in plan and "hashpartitioning(_vk" not in plan


def test_company_falls_back_to_sales_org_without_bukrs_vf(spark):
    rows = doc_set(160, vbak_BUKRS_VF=None, vbrk_BUKRS="1000")
    _, rec, _ = _run(spark, rows, edge_params(company_by="bukrs"))
    assert [(r["company"], r["order_missing"]) for r in rec.matched.collect()] == [("1000", False)]


@pytest.fixture()
def guessing(spark):
    """A session that guesses the types of folder names, as plain sessions do."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    yield spark
    spark.conf.set(key, before)


def _companies(run, name):
    return {r["company"] for r in run.get(name).select("company").collect()}


def test_reruns_keep_to_their_batch(guessing, tmp_path):
    """Batch 9 of three companies, then batch 10 of one: 10 is the newest though it sorts first as
    text, every stage holds its own companies, and 0100 stays text."""
    spark = guessing
    rows = merge_sets(doc_set(170, vkorg="0100"), doc_set(171, vkorg="2000", inv_amt="90.00"), doc_set(172, vkorg="3000", inv_qty="9"))
    t, p = make_tables(spark, **rows), edge_params()
    out = str(tmp_path / "run")
    PL.run_all(spark, t, p, out_dir=out, batch_id="9")
    ten = PL.run_all(spark, t, p, out_dir=out, batch_id="10", start="0100", limit=1)
    assert PL.open_run(spark, out, p).batch_id == "10"
    for run in (ten, PL.open_run(spark, out, p)):
        for name in ("matched", "stats", "classified"):
            assert _companies(run, name) == {"0100"}, name
        # nothing differs and nothing is untested: stages without a row
        assert run.get("report_rates").isEmpty() and run.get("detail").isEmpty() and run.get("untested").isEmpty() and run.get("verify").isEmpty()
        control = run.get("control").first()
        assert (control["rows_out"], control["invoice_keys"], control["fan_out"], control["invoice_total"]) == (1, 1, 0, 100.0)
    nine = PL.open_run(spark, out, p, "9")
    assert _companies(nine, "report_rates") == {"2000", "3000"}
    assert _companies(nine, "stats") == {"0100", "2000", "3000"} and nine.get("control").first()["rows_out"] == 3
    again = PL.run_all(spark, t, p, out_dir=out, batch_id="9", mode="diff-only")
    assert _companies(again, "stats") == {"0100", "2000", "3000"} and again.get("detail").count() == 2


def test_choice_of_companies(spark, tmp_path):
    rows = merge_sets(doc_set(173, vkorg="1000"), doc_set(174, vkorg="2000", vbak_KUNNR="4390"), doc_set(175, vkorg="3000"))
    t, p = make_tables(spark, **rows), edge_params()
    run = PL.run_all(spark, t, p, out_dir=str(tmp_path), companies=["1000", "3000"], skip=["3000"])
    assert _companies(run, "stats") == {"1000"}
    control = run.get("control").first()
    assert control["duplicate_delivery_headers"] == 0 and control["order_headers_excluded"] == 0
    run = PL.run_all(spark, t, p, out_dir=str(tmp_path), companies=["2000"])
    assert run.get("control").first()["order_headers_excluded"] == 1


def test_a_stopped_run_leaves_the_last_one(spark, tmp_path, monkeypatch):
    rows = merge_sets(doc_set(176, vkorg="1000"), doc_set(177, vkorg="2000"))
    t, p = make_tables(spark, **rows), edge_params()
    first = PL.run_all(spark, t, p, out_dir=str(tmp_path), batch_id="1")

    def stop(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(PL.S, "detail", stop)
    with pytest.raises(RuntimeError, match="lost"):
        PL.run_all(spark, t, p, out_dir=str(tmp_path), batch_id="2", limit=1)
    last = PL.open_run(spark, str(tmp_path), p)
    assert last.run_id == first.run_id and _companies(last, "classified") == {"1000", "2000"}
    with pytest.raises(FileNotFoundError):
        PL.open_run(spark, str(tmp_path), p, "2")
    from triad.plans import stages as ST
    gone = ST.clean(spark, str(tmp_path), keep=1)
    assert gone and all(first.run_id not in g or g.startswith("pivots/") for g in gone)
    assert _companies(last, "classified") == {"1000", "2000"}


def test_split_written_by_company(spark, tmp_path):
    """Six tables by company code, blank codes counted; without BUKRS_VF orders go by sales organisation,
    in the split as in the match."""
    from triad.plans import stages as ST
    rows = merge_sets(doc_set(178, vbak_BUKRS_VF="5001", vkorg="1000"), doc_set(179, vbak_BUKRS_VF=" ", vkorg="9000", vbrk_BUKRS=""))
    p = edge_params(company_by="bukrs")
    run = ST.StageRun(spark, str(tmp_path / "a"), p)
    counts = {(r["table"], r["status"]): r["rows"] for r in PL.write_split(run, make_tables(spark, **rows), p).collect()}
    for n in PL.TABLES:
        assert counts[n, "kept"] == 1 and sum(v for (t, _), v in counts.items() if t == n) == 2, counts
    assert {n: [r["VBELN"][-3:] for r in run.get(f"split_{n}").collect()] for n in PL.TABLES} == {n: ["178"] for n in PL.TABLES}
    bare = merge_sets(doc_set(180, vbak_BUKRS_VF=None, vbrk_BUKRS="1000"))
    run = ST.StageRun(spark, str(tmp_path / "b"), p)
    t = make_tables(spark, **bare)
    PL.write_split(run, t, p)
    assert _companies(run, "split_VBAK") == _companies(run, "split_VBAP") == {"1000"}
    from triad.operators.company import split_tables
    for df in split_tables(t, "bukrs").values():
        assert "hashpartitioning(VKORG" not in df._jdf.queryExecution().executedPlan().toString()


def test_empty_company_comes_back(spark, tmp_path):
    df = spark.createDataFrame([("", 1), ("1000", 2)], "company string, v int")
    PL.write_stage(df, str(tmp_path / "s"), edge_params())
    assert sorted(tuple(r) for r in PL.read_stage(spark, str(tmp_path / "s")).collect()) == [("", 1), ("1000", 2)]


def test_headers_of_one_number_and_two_companies(spark):
    """The last header row decides, for blank numbers too."""
    from triad.operators.company import tag_headers
    vbak = [{"MANDT": "100", "VBELN": v, "VKORG": "1000", "BUKRS_VF": c} for v, c in (
        ("1", "5001"), ("1", "5002"), ("2", "5001"), ("", "5003"), ("", "5004"), (" ", "5004"), ("3", " "))]
    t = make_tables(spark, vbak=vbak)
    got = sorted((r["VBELN"], r["company"]) for r in tag_headers(t, edge_params(company_by="bukrs"))["VBAK"].collect())
    assert got == [("", "5004"), ("", "5004"), ("1", "5002"), ("2", "5001")]


def test_units_line_numbers_and_materials(spark):
    """B21, B37, B38 on rows that they change."""
    df = spark.createDataFrame([("PC", "KG", "10", "M1.0"), (" ", "KG", " 000020 ", "M\u200b2.00"), (None, None, "A1", "M3")],
                               "VRKME string, MEINS string, POSNR string, MATNR string")
    got = [tuple(r) for r in df.select(X.delivery_unit(), X.posnr_norm("POSNR"), X.material_cleanup("MATNR")).collect()]
    assert got == [("PC", "000010", "M1"), ("KG", "000020", "M2"), ("", "A1", "M3")]


def test_verify_reaches_every_verdict(spark):
    from triad.operators import verify as V
    rows = merge_sets(doc_set(180), doc_set(181, vbap_KLMENG="0"), doc_set(182))
    t = make_tables(spark, **rows)
    keys = spark.createDataFrame([("1000", "0000000180", "10"), ("1000", "0000000181", "000010"), ("1000", "8000000182", "000010"),
                                  ("1000", "7777777777", "000010")], "VKORG string, VBELN string, POSNR string")
    out = {r["VBELN"]: r["verdict"] for r in V.verify_lookup(None, t, edge_params(), keys=keys).collect()}
    assert out == {"0000000180": V.VERDICTS[0], "0000000181": V.VERDICTS[1], "8000000182": V.VERDICTS[2], "7777777777": V.VERDICTS[3]}


def test_verify_of_many_keys(spark, monkeypatch):
    """few and many keys give the same rows; the tables are aggregated before the keys come, each once."""
    from triad.operators import verify as V
    rows = merge_sets(doc_set(180), doc_set(181, vbap_KLMENG="0"), doc_set(182), doc_set(183, vbrp_AUBEL=""), doc_set(184, lips_VGBEL=""))
    t = make_tables(spark, **rows)
    at = [t[n].select(F.lit("").alias("VKORG"), "VBELN", "POSNR") for n in ("VBAP", "LIPS", "VBRP")]
    keys = at[0].unionByName(at[1]).unionByName(at[2])
    keys = keys.unionByName(spark.createDataFrame([("", None, "000010"), ("", "0000000180", None), ("", "0000000180", "10")], keys.schema))
    few = V.verify_lookup(None, t, edge_params(), keys=keys)
    monkeypatch.setattr(V, "FEW_KEYS", 0)
    many = V.verify_lookup(None, t, edge_params(), keys=keys)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and many.count() == 18
    for df in (few, many):
        assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_unreferenced_documents_are_rows(spark):
    from triad.operators import invoices as IV
    from triad.operators.common import unreferenced_documents
    rows = merge_sets(*[doc_set(190 + i, vbrp_AUBEL="", vbrp_VBELV="", vbrp_POSNV="") for i in range(3)])
    t, rec, _ = _run(spark, rows)
    blank = rec.matched.where("VBELN = ''").collect()
    assert len(blank) == 1 and blank[0]["inv_docs"] == "" and blank[0]["inv_amt"] == Decimal("300.00")
    lines = IV.invoice_lines(t["VBRK"], t["VBRP"], spark.createDataFrame([], "code string"), edge_params())
    assert sorted(r["doc"] for r in unreferenced_documents(lines).collect()) == ["9000000190", "9000000191", "9000000192"]


def test_share_too_large_for_its_decimal(spark):
    from triad.operators.scenarios import pct
    df = spark.createDataFrame([(1e12, 0.01), (1.0, 3.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(pct("a", "b")).collect()] == [pytest.approx(1e16), 33.3333, None]


def test_sensitivity_names_the_companies_left_out(spark):
    rates = spark.createDataFrame(
        [("C", 1, 4, 10.0, 40.0, 25.0), ("B", 0, 2, 0.0, 7.0, 0.0), ("A", 1, 9, 1.0, 100.0, 1.0)],
        "company string, match_rows bigint, total_rows bigint, match_amt double, total_amt double, _raw_pct_amt double")
    row = R.sensitivity(rates, edge_params(tier_high=20.0)).collect()[0]
    assert (row["companies"], row["match_rows"], row["total_rows"], row["pct_amt"], row["removed_companies"]) == (1, 1, 4, 25.0, "A, B")
    none = R.sensitivity(rates.where("company = 'C'"), edge_params(tier_high=20.0)).collect()[0]
    assert none["removed_companies"] == ""
