"""Sales-order side: order lines (C1), order pivots (D1, D2), mapper (F4),
order list (B22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from .common import CKEY, JKEY, company_column, drop_excluded, header_join

ORDER_MEASURES = ["ord_amt_fc", "ord_amt_lc", "ord_qty"]


def order_lines(vbak: DataFrame, vbap: DataFrame, excl: DataFrame, p: Params) -> DataFrame:
    """C1 + B6, B9, B12, B15 + C7: one row per order line and material.

    No date filter (as in the process) unless ``filter_order_period_in_match``.
    Output is hash-partitioned on the match key so the material-grain pivot,
    the key-grain pivot and the three-way join share one exchange.
    """
    # worked out where a line is read, so that fewer columns are shuffled to the headers
    d = header_join(vbap.withColumn("ord_qty", X.order_base_qty(p)), vbak)
    if p.company_by != "vkorg" and "company" in vbak.columns:
        d = d.where(F.col("company").isNotNull())
    d = d.select(
        F.coalesce(company_column(d), F.lit("")).alias("company"),
        F.coalesce(F.col("VKORG"), F.lit("")).alias("VKORG"),
        F.coalesce(F.col("VBELN"), F.lit("")).alias("VBELN"),
        F.coalesce(F.col("POSNR"), F.lit("")).alias("POSNR"),
        X.material_norm("MATNR").alias("MATNR"),
        "ARKTX", "AUART", "KUNNR", "VKGRP", "VKBUR", "ERDAT", "AUDAT",
        X.order_date().alias("order_date"),
        "MEINS", "KWMENG", "KLMENG", "VRKME", "NETWR", "NETPR", "WAERK", "WKURS", "WERKS", "LGORT", "VSTEL",
        "ord_qty",
        F.coalesce(F.col("NETWR"), F.lit(0)).alias("ord_amt_fc"),
        (F.coalesce(F.col("NETWR"), F.lit(0)) * F.coalesce(F.col("WKURS"), X.dec(p.missing_rate))).alias("ord_amt_lc"),
        "_ord",
    )
    if p.filter_order_period_in_match:
        d = d.where(X.in_period("order_date", p.order_period))
    return drop_excluded(d, "KUNNR", excl)


#: What :func:`material_grain` takes from an order line.
GRAIN_COLUMNS = [*JKEY, "MATNR", *ORDER_MEASURES, "ARKTX", "AUART", "_ord"]


def material_grain(lines: DataFrame) -> DataFrame:
    """D1 with the extra columns the order-line pivot folds up: sums by
    (VKORG, VBELN, POSNR, MATNR), description of the group's first source
    row, first non-null order type and the source position it came from (both from
    one smallest row: a position is text, and the aggregation carries it twice, not thrice).
    Of lines without position, type and description the sums only."""
    sums = [F.sum(c).alias(c) for c in ORDER_MEASURES]
    if "_ord" not in lines.columns:
        return lines.groupBy(*JKEY, "MATNR").agg(*sums)
    typed = F.struct(F.col("AUART").isNull().alias("_null"), F.col("_ord").alias("_ord"), F.col("AUART"))
    g = lines.groupBy(*JKEY, "MATNR").agg(*sums, F.min_by("ARKTX", F.col("_ord")).alias("ARKTX"), F.min(typed).alias("_typed"))
    return g.select(*g.columns[:-1], F.col("_typed.AUART").alias("AUART"),
                    F.struct(F.col("_typed._null").alias("_null"), F.col("_typed._ord").alias("_ord")).alias("_auart_pos"))


def order_pivot(lines_or_grain: DataFrame) -> DataFrame:
    """D1 (+C11): sums by (VKORG, VBELN, POSNR, MATNR); first order type.
    Accepts order lines or the output of :func:`material_grain`."""
    g = lines_or_grain if "_auart_pos" in lines_or_grain.columns else material_grain(lines_or_grain)
    return g.select(*CKEY, "MATNR", "ord_amt_fc", "ord_amt_lc", "ord_qty", "AUART")


def order_key_pivot(grain: DataFrame) -> DataFrame:
    """D2 + C10 + C11 at order-line grain, folded up from the material grain
    (:func:`material_grain`, already hash-partitioned on the key, so this
    aggregation adds no exchange).

    Sums over all materials of the line; MATNR = smallest material (the
    process takes the first after a key-sorted pivot); ARKTX = description of
    the first source row of that material (the mapper keeps the first row);
    AUART = first non-null order type over all rows of the line.
    ``n_materials`` > 1 marks the lines the process reports as
    multi-material (D24).
    """
    return (grain.groupBy(*JKEY)
            .agg(F.sum("ord_amt_fc").alias("ord_amt_fc"),
                 F.sum("ord_amt_lc").alias("ord_amt_lc"),
                 F.sum("ord_qty").alias("ord_qty"),
                 F.min("MATNR").alias("MATNR"),
                 F.min_by("ARKTX", F.col("MATNR")).alias("ARKTX"),
                 F.min_by("AUART", F.col("_auart_pos")).alias("AUART"),
                 F.count(F.lit(1)).alias("n_materials")))


def material_mapper(lines: DataFrame) -> DataFrame:
    """one description per (MATNR, VKORG, VBELN, POSNR), first row wins."""
    return (lines.groupBy(*JKEY, "MATNR")
            .agg(F.min_by("ARKTX", F.col("_ord")).alias("ARKTX")))


def lines_of_headers(vbak: DataFrame, vbap: DataFrame) -> DataFrame:
    """Order lines whose order number has a header."""
    return vbap.join(vbak.select("VBELN").distinct(), "VBELN", "left_semi")


def order_list(vbak: DataFrame, vbap: DataFrame, excl: DataFrame, p: Params) -> DataFrame:
    """B22 (+C5): the order list with business column names."""
    vbap = lines_of_headers(vbak, vbap)
    d = order_lines(vbak, vbap, excl, p.with_(filter_order_period_in_match=False))
    return d.select(
        F.col("VKORG").alias("sales_org"), F.col("VBELN").alias("order_no"), F.col("POSNR").alias("order_item"),
        F.col("AUART").alias("order_type"), F.col("MATNR").alias("material"), F.col("ARKTX").alias("material_text"),
        F.col("KUNNR").alias("sold_to"), F.col("VKGRP").alias("sales_group"), F.col("VKBUR").alias("sales_office"),
        F.col("order_date"), F.col("ERDAT").alias("created_on"), F.col("AUDAT").alias("doc_date"),
        F.col("MEINS").alias("base_unit"), F.col("KWMENG").alias("qty_sales_unit"),
        F.col("KLMENG").alias("qty_base_unit"), F.col("VRKME").alias("sales_unit"),
        F.col("NETWR").alias("net_value"), F.col("NETPR").alias("net_price"),
        F.col("ord_qty").alias("qty_calc"), F.col("ord_amt_fc").alias("amount_fc_calc"),
        F.col("ord_amt_lc").alias("amount_lc_calc"), F.col("WAERK").alias("currency"),
        F.col("WKURS").alias("exchange_rate"), F.col("WERKS").alias("plant"),
        F.col("LGORT").alias("storage_loc"), F.col("VSTEL").alias("shipping_point"),
    )
