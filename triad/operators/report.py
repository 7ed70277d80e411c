"""Group report: scenario tables (D12, D13), four classes (D14), match rates
and tiers (D15–D18), internal-only flag (D19), untested summary (D20) and
missing-invoice amount (D22).

Inputs are the per-company statistics of :func:`scenarios.scenario_stats`
(a few rows per company), so everything here is small after the first
aggregation; windows are partitioned by company.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SCENARIO_CLASSES, Params
from ..functions import exprs as X
from ..session import distributed_numbers
from .common import drop_excluded, keep_first
from .scenarios import MISSING_INVOICE, NEGATIVE, pct

GROUP = "ALL"
TABLE_LINES = ("1", "2", "3", "4", "5", "6", "7", "8", "9", "11", "12", "13")


def _basis_rows(stats: DataFrame, basis: str) -> DataFrame:
    """Figures as the report reads them.  basis="reported": scenario 10 and
    0 count as zero (the statistics leave them out, so the report's
    "no difference" class holds only 3); basis="full": 10 is counted."""
    if basis not in ("reported", "full"):
        raise ValueError(basis)
    keep = F.col("reported") | ((F.col("scenario") == 10) & F.lit(basis == "full"))
    z = F.lit(0)
    return stats.select(
        "company", "scenario",
        F.when(keep, F.col("rows")).otherwise(z).cast("bigint").alias("rows"),
        F.when(keep, F.col("inv_amt")).otherwise(F.lit(0.0)).cast("decimal(38,2)").alias("inv_amt"),
        F.when(keep, F.col("order_inv_diff")).otherwise(F.lit(0.0)).cast("decimal(38,2)").alias("order_inv_diff"),
    )


def group_scenarios(stats: DataFrame) -> DataFrame:
    """All companies added per scenario (company = 'ALL')."""
    return (stats.groupBy("scenario")
            .agg(F.sum("rows").cast("bigint").alias("rows"),
                 F.sum(F.col("inv_amt").cast("decimal(38,2)")).cast("double").alias("inv_amt"),
                 F.sum(F.col("order_inv_diff").cast("decimal(38,2)")).cast("double").alias("order_inv_diff"),
                 F.bool_or("reported").alias("reported"))
            .select(F.lit(GROUP).alias("company"), "scenario", "rows", "inv_amt", "order_inv_diff", "reported"))


def scenario_table(stats: DataFrame, basis: str = "reported", with_group: bool = True,
                   hide_order_inv_diff: bool = False) -> DataFrame:
    """The report table per company (and for the group, 'ALL').

    Lines 1–9, 11–13; ``subtotal`` (1–13); ``14`` negative invoices;
    ``total`` (subtotal + 14).  % rows over the subtotal rows for every line
    incl. 14; % amount over the subtotal amount (line 7: 0), line 14 over the
    total amount; the total line carries no percentages.

    One wide aggregate per company (``rollup`` adds the group line in the
    same pass), then one explode to the table lines.
    """
    # Written as SQL text: the ~50 aggregates and 16 table lines are parsed
    # in a few calls instead of being built node by node on the driver.
    s = _basis_rows(stats, basis)
    dec0 = "CAST(0 AS DECIMAL(38,2))"

    def sums(cond: str, suffix: str) -> list[str]:
        return [f"sum(CASE WHEN {cond} THEN rows ELSE 0 END) AS n{suffix}",
                f"coalesce(sum(CASE WHEN {cond} THEN inv_amt END), {dec0}) AS a{suffix}",
                f"coalesce(sum(CASE WHEN {cond} THEN order_inv_diff END), {dec0}) AS d{suffix}"]

    aggs = sums("scenario BETWEEN 1 AND 13", "sub")
    for sid in [int(x) for x in TABLE_LINES] + [NEGATIVE]:
        aggs += sums(f"scenario = {sid}", str(sid))
    g = s.rollup("company") if with_group else s.groupBy("company")
    wide = g.agg(F.expr("grouping(company)").alias("_g"), *[F.expr(a) for a in aggs])
    wide = wide.withColumn("company", F.when(F.col("_g") == 1, F.lit(GROUP)).otherwise(F.col("company")))

    def pct_sql(a: str, b: str) -> str:
        v = f"100.0D * CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)"
        return (f"CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN CAST(NULL AS DOUBLE) "
                f"ELSE coalesce(CAST(TRY_CAST({v} AS DECIMAL(18,4)) AS DOUBLE), {v}) END")

    nul = "CAST(NULL AS DOUBLE)"
    nz_sub_a = "abs(asub) >= 1e-9D"

    def item(line: str, order: int, n: str, a: str, d: str, pr: str, pa: str) -> str:
        return (f"named_struct('line', '{line}', 'line_order', {order}, 'rows', CAST({n} AS BIGINT), "
                f"'pct_rows', {pr}, 'inv_amt', CAST({a} AS DOUBLE), 'pct_amt', {pa}, "
                f"'order_inv_diff', CAST({d} AS DOUBLE))")

    items = []
    for x in TABLE_LINES:
        sid = int(x)
        n, a = f"n{sid}", f"a{sid}"
        pr = f"CASE WHEN nsub > 0 AND {n} != 0 THEN {pct_sql(n, 'nsub')} ELSE 0.0D END"
        pa = "0.0D" if sid == MISSING_INVOICE else f"CASE WHEN {nz_sub_a} THEN {pct_sql(a, 'asub')} ELSE {nul} END"
        items.append(item(x, sid, n, a, f"d{sid}", pr, pa))
    items.append(item("subtotal", 20, "nsub", "asub", "dsub", "CASE WHEN nsub > 0 THEN 100.0D ELSE 0.0D END",
                      f"CASE WHEN {nz_sub_a} THEN 100.0D ELSE 0.0D END"))
    nn, na, tot = f"n{NEGATIVE}", f"a{NEGATIVE}", f"(asub + a{NEGATIVE})"
    items.append(item("14", 21, nn, na, "CAST(NULL AS DECIMAL(38,2))",
                      f"CASE WHEN nsub > 0 THEN {pct_sql(nn, 'nsub')} ELSE 0.0D END",
                      f"CASE WHEN abs({tot}) >= 1e-9D THEN {pct_sql(na, tot)} ELSE {nul} END"))
    items.append(item("total", 22, f"(nsub + {nn})", tot, "dsub", nul, nul))
    out = wide.selectExpr("company", f"inline(array({', '.join(items)}))")
    return out.drop("order_inv_diff") if hide_order_inv_diff else out


def four_classes(stats: DataFrame, basis: str = "reported") -> DataFrame:
    """none = 3+10, amount = 1+2+8+9+12+13, quantity = 6+11,
    both = 4+5 (rows and invoice amount per company)."""
    s = _basis_rows(stats, basis)
    cls = None
    for name, ids in SCENARIO_CLASSES:
        cond = F.col("scenario").isin(*ids)
        cls = F.when(cond, F.lit(name)) if cls is None else cls.when(cond, F.lit(name))
    return (s.withColumn("class", cls).where(F.col("class").isNotNull())
             .groupBy("company", "class")
             .agg(F.sum("rows").cast("bigint").alias("rows"),
                  F.sum("inv_amt").cast("decimal(38,2)").cast("double").alias("inv_amt")))


def _tier(pct_amt: Column, p: Params) -> Column:
    return (F.when(pct_amt >= p.tier_high, F.lit("high"))
             .when(pct_amt >= p.tier_mid, F.lit("mid")).otherwise(F.lit("low")))


def company_match_rate(stats: DataFrame, p: Params, basis: str = "reported") -> DataFrame:
    """Matched (class none) over all four classes, per company; tier by
    the raw amount %; companies with neither rows nor amount are skipped."""
    s = _basis_rows(stats, basis)
    none_ids = dict(SCENARIO_CLASSES)["none"]
    in4 = F.col("scenario").isin(*[i for _, ids in SCENARIO_CLASSES for i in ids])
    m = s.groupBy("company").agg(
        F.sum(F.when(F.col("scenario").isin(*none_ids), F.col("rows")).otherwise(0)).alias("match_rows"),
        F.sum(F.when(in4, F.col("rows")).otherwise(0)).alias("total_rows"),
        F.sum(F.when(F.col("scenario").isin(*none_ids), F.col("inv_amt"))).alias("match_amt"),
        F.sum(F.when(in4, F.col("inv_amt"))).alias("total_amt"),
        F.sum(F.when(F.col("scenario") == NEGATIVE, F.col("inv_amt"))).alias("neg_amt"),
    ).na.fill(0, ["match_amt", "total_amt", "neg_amt"])
    m = m.where((F.col("total_amt") > 0) | (F.col("total_rows") > 0))
    pa = F.when(F.col("total_amt") > 0, pct("match_amt", "total_amt")).otherwise(F.lit(0.0))
    pr = F.when(F.col("total_rows") > 0, pct("match_rows", "total_rows")).otherwise(F.lit(0.0))
    raw_pa = F.when(F.col("total_amt") > 0, F.col("match_amt").cast("double") * 100.0
                    / F.col("total_amt").cast("double")).otherwise(F.lit(0.0))
    tier = _tier(raw_pa, p)
    return m.select(
        "company", F.col("match_rows").cast("bigint").alias("match_rows"),
        F.col("total_rows").cast("bigint").alias("total_rows"), pr.alias("pct_rows"),
        F.col("match_amt").cast("double").alias("match_amt"), F.col("total_amt").cast("double").alias("total_amt"),
        pa.alias("pct_amt"), raw_pa.alias("_raw_pct_amt"), tier.alias("tier"),
        F.when(tier == "low", F.lit(f"amount match rate < {p.tier_mid:g}%")).otherwise(F.lit("")).alias("remark"),
        F.col("neg_amt").cast("double").alias("neg_amt"))


def _summary(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("companies"),
            F.coalesce(F.sum("match_rows"), F.lit(0)).cast("bigint").alias("match_rows"),
            F.coalesce(F.sum("total_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.coalesce(F.sum(F.col("match_amt").cast("decimal(38,2)")), F.lit(0)).alias("_ma"),
            F.coalesce(F.sum(F.col("total_amt").cast("decimal(38,2)")), F.lit(0)).alias("_ta")]


def _finish(df: DataFrame, *keys: str, more: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keys, "companies", "match_rows", "total_rows",
                     F.when(F.col("total_rows") > 0, pct("match_rows", "total_rows")).alias("pct_rows"),
                     F.col("_ma").cast("double").alias("match_amt"), F.col("_ta").cast("double").alias("total_amt"),
                     F.when(F.col("_ta") > 0, pct("_ma", "_ta")).alias("pct_amt"), *more)


def tier_summary(spark: SparkSession, rates: DataFrame) -> DataFrame:
    """Companies, rows and amounts per tier; an empty tier shows zeros
    and null percentages.  The tier dimension is a 3-row literal."""
    dim = spark.createDataFrame([("high", 1), ("mid", 2), ("low", 3)], "tier string, tier_order int")
    agg = rates.groupBy("tier").agg(*_summary(rates))
    j = dim.join(agg, "tier", "left").na.fill(0, ["companies", "match_rows", "total_rows", "_ma", "_ta"])
    return _finish(j, "tier", "tier_order")


def overall_match(rates: DataFrame) -> DataFrame:
    """All retained companies together (one row)."""
    return _finish(rates.agg(*_summary(rates)).withColumn("scope", F.lit("all")), "scope")


def sensitivity(rates: DataFrame, p: Params) -> DataFrame:
    """Only companies at or above the high tier (raw %), plus the sorted
    list of companies left out (one row, from one pass over the rates; the list
    as rows, for any number of companies, is :func:`removed_companies`)."""
    hi = F.col("_raw_pct_amt") >= p.tier_high
    kept = rates.select(*[F.when(hi, F.col(c)).alias(c) for c in ("match_rows", "total_rows", "match_amt", "total_amt")],
                        F.when(hi, 1).alias("_hi"), F.when(~hi, F.col("company")).alias("_out"))
    one = kept.agg(F.count("_hi").alias("companies"), *_summary(kept)[1:],
                   F.array_join(F.array_sort(F.collect_list("_out")), ", ").alias("removed_companies"))
    return _finish(one.withColumn("scope", F.lit(f">={p.tier_high:g}%")), "scope", more=("removed_companies",))


def removed_companies(rates: DataFrame, p: Params) -> DataFrame:
    """The companies below the high tier as rows, for any number of them."""
    return rates.where(F.col("_raw_pct_amt") < p.tier_high).select("company", "pct_amt")


def internal_only(stats: DataFrame, basis: str = "reported") -> DataFrame:
    """Companies whose scenarios 1–13 hold no rows at all."""
    s = _basis_rows(stats, basis)
    return (s.groupBy("company")
             .agg(F.sum(F.when(F.col("scenario").between(1, 13), F.col("rows")).otherwise(0)).alias("_n"))
             .select("company", (F.col("_n") == 0).alias("internal_only")))


def valid_orders(vbak: DataFrame, excl: DataFrame, p: Params) -> DataFrame:
    """Orders of the audit period for the untested summary (F3, B17, B18,
    C7): first header row per VBELN, order date in the period, order type
    not excluded (and equal to ``order_type`` when set), sold-to not
    excluded.  Column ``VBELN``."""
    h = keep_first(vbak.select("VBELN", "AUDAT", "ERDAT", "AUART", "KUNNR", "_ord"), ["VBELN"])
    h = h.where(X.in_period(X.order_date(), p.order_period) & X.order_type_kept(p))
    h = drop_excluded(h, "KUNNR", excl)
    return h.select("VBELN")


def untested_summary(untested_rows: DataFrame, vbak: DataFrame, excl: DataFrame, p: Params) -> DataFrame:
    """Per company rows and order amount of the untested classes
    order-only and order-and-delivery, restricted to valid orders; plus a
    grand-total line (company 'TOTAL')."""
    # An empty valid-order set filters everything (the process would switch
    # the filter off; that needs a driver-side emptiness test and is not offered).
    v = valid_orders(vbak, excl, p).withColumn("_valid", F.lit(True))
    oo, od = F.col("class") == "order_only", F.col("class") == "order_delivery"
    zero = F.lit(0)
    # one read of the untested rows: a company without any such row keeps its line of zeros
    per = untested_rows.join(v, "VBELN", "left").groupBy("company").agg(
        F.sum(F.when(oo & F.col("_valid"), 1).otherwise(0)).alias("order_only_rows"),
        F.coalesce(F.sum(F.when(oo & F.col("_valid"), F.col("ord_amt_lc"))), zero).alias("order_only_amt"),
        F.sum(F.when(od & F.col("_valid"), 1).otherwise(0)).alias("order_delivery_rows"),
        F.coalesce(F.sum(F.when(od & F.col("_valid"), F.col("ord_amt_lc"))), zero).alias("order_delivery_amt"))
    cube = per.rollup("company").agg(*[F.sum(c).alias(c) for c in
                                       ("order_only_rows", "order_only_amt", "order_delivery_rows",
                                        "order_delivery_amt")])
    return cube.select(
        F.coalesce(F.col("company"), F.lit("TOTAL")).alias("company"),
        F.col("order_only_rows").cast("bigint").alias("order_only_rows"),
        F.col("order_only_amt").cast("decimal(38,2)").cast("double").alias("order_only_amt"),
        F.col("order_delivery_rows").cast("bigint").alias("order_delivery_rows"),
        F.col("order_delivery_amt").cast("decimal(38,2)").cast("double").alias("order_delivery_amt"),
        (F.col("order_only_rows") + F.col("order_delivery_rows")).cast("bigint").alias("total_rows"),
        (F.col("order_only_amt") + F.col("order_delivery_amt")).cast("decimal(38,2)").cast("double")
        .alias("total_amt"))


def missing_invoice_amount(untested_rows: DataFrame) -> DataFrame:
    """Rows and order amount without an invoice, per company."""
    u = untested_rows.where(F.col("class").isin("order_only", "order_delivery"))
    return (u.groupBy("company")
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.sum("ord_amt_lc").cast("decimal(38,2)").cast("double").alias("order_amt")))


def malformed_rows(dropped: dict[str, DataFrame]) -> DataFrame:
    """A5: rows with too many fields that the extract reader dropped, by table."""
    return reduce(DataFrame.unionByName, [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, d in dropped.items()])


# ---------------------------------------------------------------------------
# Report numbers as text, and back
# ---------------------------------------------------------------------------
# Numbers stay numeric in every dataset; these are display projections only.
# Values are rounded half-even first, so the formatting itself never rounds.

def amount_text(c, digits: int = 2) -> Column:
    """0 -> '-', thousands separators, negative in brackets, null -> ''."""
    r = F.bround(F.col(c).cast("decimal(38,6)") if isinstance(c, str) else c.cast("decimal(38,6)"), digits)
    body = F.format_number(F.abs(r), digits)
    return (F.when(r.isNull(), F.lit("")).when(r == 0, F.lit("-"))
             .when(r < 0, F.concat(F.lit("("), body, F.lit(")"))).otherwise(body))


def pct_text(c, missing: str = "") -> Column:
    """Percentage with two decimals and a '%' sign; null -> ``missing``."""
    r = F.bround((F.col(c) if isinstance(c, str) else c).try_cast("decimal(38,6)"), 2)
    return F.when(r.isNull(), F.lit(missing)).otherwise(F.concat(F.format_number(r, 2), F.lit("%")))


def parse_report_number(c) -> Column:
    """Text of :func:`amount_text` / :func:`pct_text` back to a decimal."""
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    v = F.regexp_replace(t, r"[(),%\s]", "").try_cast("decimal(38,6)")
    return (F.when(t.isin("-", ""), F.lit(0).cast("decimal(38,6)"))
             .when(t.startswith("(") & t.endswith(")"), -v).otherwise(v))


def display_table(table: DataFrame) -> DataFrame:
    """The scenario table (D13) as report text, with the invoice amount also
    parsed back from its text (a check that the two agree).  An undefined share
    is 'N/A', the total line has no shares and line 14 no difference."""
    total, negative = F.col("line") == "total", F.col("line") == str(NEGATIVE)
    return table.select(
        "company", "line", "line_order",
        amount_text("rows", 0).alias("rows_text"),
        pct_text("pct_rows").alias("pct_rows_text"),
        amount_text("inv_amt").alias("inv_amt_text"),
        F.when(total, F.lit("")).otherwise(pct_text("pct_amt", "N/A")).alias("pct_amt_text"),
        F.when(negative, F.lit("-")).otherwise(amount_text("order_inv_diff")).alias("diff_text"),
        parse_report_number(amount_text("inv_amt")).cast("double").alias("inv_amt_back"),
    )


def ordered_report(table: DataFrame) -> DataFrame:
    """a report table in display order (companies ascending, lines in
    their fixed order) with its 1-based ``position``, numbered where the rows
    are (no window over all rows)."""
    return distributed_numbers(table, ["company", "line_order"]).orderBy("position")
