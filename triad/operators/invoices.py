"""Invoice side: invoice lines (C3, B4, B16, C7, B8, B11, B13, B20),
invoice pivot (D4, D5, D6) and the invoice list (B5, B25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from .deliveries import order_set_filter
from .common import CKEY, JKEY, company_column, doc_list, drop_excluded, first_non_null, header_join, non_null_keys


#: Folder column of invoice lines staged by billing month.
MONTH = "bill_month"


def _period_lines(vbrk: DataFrame, vbrp: DataFrame, p: Params) -> DataFrame:
    """C3 + B16.  The period predicate is applied to the line scan first
    (pushed into Parquet as a range on FKDAT; lines without a date keep
    their chance through the header date), then exactly after the join."""
    pushed = X.in_period("FKDAT", p.invoice_period) | F.col("FKDAT").isNull()
    if MONTH in vbrp.columns:
        if p.invoice_period is not None:
            first, last = (d.year * 100 + d.month for d in (p.invoice_period.first_day, p.invoice_period.last_day))
            vbrp = vbrp.where(F.col(MONTH).between(first, last) | (F.col(MONTH) == 0))
        vbrp = vbrp.drop(MONTH)
    d = header_join(vbrp.where(pushed), vbrk)
    return d.where(X.in_period("FKDAT", p.invoice_period))


def by_billing_month(vbrk: DataFrame, vbrp: DataFrame) -> DataFrame:
    """VBRP with its billing month (yyyymm) from the line or, where the line has no date,
    from its header; 0 where neither says, or where headers of one number differ.
    Written in folders by it, a run of one period reads the folders of its months and
    the folder 0 only, so lines dated by their header are pruned too."""
    date = F.coalesce("FKDAT", F.when(F.col("_first") == F.col("_last"), F.col("_first")))
    month = F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0)).alias(MONTH)
    dates = vbrk.groupBy("MANDT", "VBELN").agg(F.min("FKDAT").alias("_first"), F.max("FKDAT").alias("_last"))
    bare = vbrp.where(F.col("FKDAT").isNull()).join(dates, ["MANDT", "VBELN"], "left")
    dated = vbrp.where(F.col("FKDAT").isNotNull())
    nothing = F.lit(None).cast("date")
    return dated.select("*", nothing.alias("_first"), nothing.alias("_last")).unionByName(bare).select(*vbrp.columns, month)


def invoice_lines(vbrk: DataFrame, vbrp: DataFrame, excl: DataFrame, p: Params,
                  known: DataFrame | None = None) -> DataFrame:
    """Invoice lines of the match stage, keyed to the order line.

    B4: the order key is AUBEL/AUPOS; when either is blank, both come from
    VBELV/POSNV (a delivery number, which then rarely matches an order).
    """
    d = _period_lines(vbrk, vbrp, p)
    if p.invoice_order_filter and known is not None:  # C6, off in the process
        d = order_set_filter(d, known, ("VBELV", "AUBEL"))
    order_no, order_item = X.invoice_order_key()
    d = d.withColumn("ORD_VBELN", order_no).withColumn("ORD_POSNR", order_item)
    d = drop_excluded(d, "KUNAG", excl)
    return (d.withColumn("inv_amt", X.signed("NETWR"))
             .withColumn("inv_qty", X.base_qty("FKLMG", "FKIMG", p) * X.sign("SHKZG"))
             .where(X.nonzero("FKIMG", p) | X.nonzero("NETWR", p)))


def invoice_pivot(lines: DataFrame) -> DataFrame:
    """D4 + D5 + D6: amount, quantity, first invoice type and invoice
    numbers per order line; a null key drops the row (pivot semantics)."""
    keyed = lines.select(company_column(lines), F.col("VKORG"), F.col("ORD_VBELN").alias("VBELN"), F.col("ORD_POSNR").alias("POSNR"),
                         F.col("VBELN").alias("_inv_no"), "FKART", "inv_amt", "inv_qty", "_ord")
    return (non_null_keys(keyed, CKEY).groupBy(*JKEY)
            .agg(F.sum("inv_amt").alias("inv_amt"), F.sum("inv_qty").alias("inv_qty"),
                 first_non_null("FKART").alias("inv_type"), doc_list("_inv_no").alias("inv_docs")))


def invoice_list(vbrk: DataFrame, vbrp: DataFrame, excl: DataFrame, p: Params) -> DataFrame:
    """The invoice list.  B5: VBELV <- AUBEL, POSNV <- AUPOS per column
    (the opposite preference of the match key); sales-unit quantity (B14)."""
    d = header_join(vbrp, vbrk)
    d = (d.withColumn("VBELV", X.fill_if_blank("VBELV", "AUBEL"))
          .withColumn("POSNV", X.fill_if_blank("POSNV", "AUPOS"))
          .where(X.in_period("FKDAT", p.invoice_period)))
    d = drop_excluded(d, "KUNAG", excl)
    d = (d.withColumn("inv_amt", X.signed("NETWR"))
          .withColumn("inv_qty", X.signed("FKIMG"))
          .where(X.nonzero("FKIMG", p) | X.nonzero("NETWR", p)))
    return d.select(
        F.col("VKORG").alias("sales_org"), F.col("VBELN").alias("invoice_no"), F.col("POSNR").alias("invoice_item"),
        F.col("VBELV").alias("order_no"), F.col("POSNV").alias("order_item"), F.col("MATNR").alias("material"),
        F.col("ARKTX").alias("material_text"), F.col("KUNRG").alias("payer"), F.col("KUNAG").alias("sold_to"),
        F.col("KUNNR").alias("customer"), F.col("BUKRS").alias("company_code"), F.col("FKART").alias("invoice_type"),
        F.col("FKIMG").alias("qty_sales_unit"), F.col("VRKME").alias("sales_unit"), F.col("NETWR").alias("net_value"),
        F.col("AKKUR").alias("stat_amount"), F.col("MWSBP").alias("tax_amount"),
        F.col("inv_qty").alias("qty_calc"), F.col("inv_amt").alias("amount_lc_calc"), F.col("SHKZG").alias("dc_flag"),
        F.col("FKDAT").alias("billing_date"), F.col("WAERK").alias("currency"), F.col("ERDAT").alias("created_on"),
    )
