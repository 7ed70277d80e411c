"""Delivery side: delivery lines (F1, F2, C2, C4, B3, B8, B10, B19, C8),
delivery pivot (D3, D5) and the delivery lists (B23, B24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from ..session import written
from .common import CKEY, JKEY, company_column, doc_list, header_join, keep_first, non_null_keys


def _joined(likp: DataFrame, lips: DataFrame, dedup: bool) -> DataFrame:
    """F1, F2, C2.  Keep-first windows partition on the full line key, so
    even one delivery holding a large share of all lines spreads over many
    tasks (no explicit repartition on the delivery number alone)."""
    if dedup:
        likp = keep_first(likp, ["VBELN", "MANDT"])
        lips = keep_first(lips, ["VBELN", "POSNR", "MANDT"])
    return header_join(lips, likp)


def known_orders(vbak: DataFrame) -> DataFrame:
    """Distinct order numbers of the order headers (column ``_k``); a
    missing or empty number is no order.  Headers with a company give each
    company its own set (column ``_kc``)."""
    of = [F.col("company").alias("_kc")] if "company" in vbak.columns else []
    return vbak.select(F.col("VBELN").alias("_k"), *of).where(F.col("_k").isNotNull() & (F.col("_k") != "")).distinct()


def references(d: DataFrame, cols: tuple[str, str]) -> DataFrame:
    """With a line's reference ``_ref``, and ``_also`` where its second column has another one."""
    a, b = (F.nullif(F.col(c), F.lit("")) for c in cols)
    return d.withColumn("_ref", F.coalesce(a, b)).withColumn("_also", F.when(a != b, b))


def order_set_filter(d: DataFrame, known: DataFrame, cols: tuple[str, str] = ("VBELV", "VGBEL")) -> DataFrame:
    """C4 (and C6 with ``cols=("VBELV", "AUBEL")``): keep lines whose first
    *or* second reference column is a known order number.

    A line nearly always has one reference: both columns agree, or one is missing
    or empty.  Such lines go through one semi join on it.  Only lines with two
    different references are looked up twice, by two left joins with hit flags.
    Lines without a reference, often half of all, match nothing and go before
    any shuffle.  A hot order number is a hot key on the preserved side of the
    join, which AQE's skew-join handling splits.  Nothing is dropped or sampled.
    """
    own = "_kc" in known.columns and "company" in d.columns
    d = (d if "_ref" in d.columns else references(d, cols)).where(F.col("_ref").isNotNull())

    def on(left: DataFrame, ref: str, k: DataFrame):
        same = left[ref] == k["_k"]
        return same & (left["company"] == k["_kc"]) if own else same

    one = d.where(F.col("_also").isNull())
    one = one.join(known, on(one, "_ref", known), "left_semi")
    two = d.where(F.col("_also").isNotNull())
    names = two.columns
    for i, ref in enumerate(("_ref", "_also")):
        k = known.withColumn(f"_hit{i}", F.lit(True))
        two = two.join(k, on(two, ref, k), "left").select(*names, *[f"_hit{j}" for j in range(i + 1)])
    two = two.where("_hit0 OR _hit1").select(*names)
    return one.unionByName(two).drop("_ref", "_also")


def batch_child_dedup(d: DataFrame, scratch: str | None = None) -> DataFrame:
    """Drop a batch child line when its parent line (same delivery,
    referenced by UEPOS or UECHA) is present; runs after the zero filter, so
    a zero-quantity parent does not remove its children.

    Parents pass through untouched.  Only the child rows, which are few, are
    looked up against the (delivery, position) pairs of the parents: one
    left-anti join on the pointer, and a second one only for children with two
    different pointers.  The delivery lines themselves are not shuffled again.
    The lines are written once to the shared folder (``scratch``, if given), because parents,
    children and pairs all come from them; callers pass only the columns they need.
    """
    d = written(d, "delivery-lines", scratch)
    is_parent = X.blank_parent_ref("UEPOS") & X.blank_parent_ref("UECHA")
    parents, children = d.where(is_parent), d.where(~is_parent)
    place = parents.select(F.col("VBELN").alias("_pv"), F.col("POSNR").alias("_pp"))
    # a blank pointer looks nothing up
    a, b = (F.when(~X.blank_parent_ref(c), F.col(c)) for c in ("UEPOS", "UECHA"))
    children = children.withColumn("_at", F.coalesce(a, b)).withColumn("_also", F.when(a != b, b))

    def orphans(c: DataFrame, ref: str) -> DataFrame:
        return c.join(place, (c["VBELN"] == place["_pv"]) & (c[ref] == place["_pp"]), "left_anti")

    one, two = children.where(F.col("_also").isNull()), children.where(F.col("_also").isNotNull())
    kept = orphans(one, "_at").unionByName(orphans(orphans(two, "_at"), "_also")).drop("_at", "_also")
    return parents.unionByName(kept)


def delivery_lines(likp: DataFrame, lips: DataFrame, known: DataFrame | None, p: Params,
                   batch_dedup: bool = True, scratch: str | None = None) -> DataFrame:
    """Delivery lines of the match stage, keyed to the order line; with
    ``batch_dedup`` only the columns of the match, from lines written to ``scratch``.

    F1/F2 keep-first, C2 header join, C4 order filter, B3 order reference
    (VBELV <- VGBEL, POSNV <- VGPOS, each where blank), B8 sign, B10 base
    quantity, B19 non-zero LFIMG, C8 batch-child de-duplication.
    """
    # what a line says by itself is worked out where it is read: fewer columns are shuffled
    lips = (references(lips, ("VBELV", "VGBEL"))
            .withColumn("ORD_VBELN", X.fill_if_blank("VBELV", "VGBEL"))
            .withColumn("ORD_POSNR", X.fill_if_blank("POSNV", "VGPOS"))
            .withColumn("dlv_qty", X.base_qty("LGMNG", "LFIMG", p) * X.sign("SHKZG"))
            .withColumn("_kept", X.nonzero("LFIMG", p)))
    d = _joined(likp, lips, dedup=True).where("_kept").drop("_kept")
    d = d.drop("_ref", "_also") if known is None else order_set_filter(d, known)
    if batch_dedup:
        slim = ["VKORG", "VBELN", "POSNR", "UEPOS", "UECHA", "ORD_VBELN", "ORD_POSNR", "dlv_qty"]
        d = batch_child_dedup(d.select(*[c for c in ("company",) if c in d.columns], *slim), scratch)
    return d


def delivery_pivot(lines: DataFrame) -> DataFrame:
    """D3 + D5: delivery quantity and delivery numbers per order line.
    Rows with a null VKORG (no header) vanish, as in the process."""
    keyed = lines.select(company_column(lines), F.col("VKORG"), F.col("ORD_VBELN").alias("VBELN"), F.col("ORD_POSNR").alias("POSNR"),
                         F.col("VBELN").alias("_dlv_no"), "dlv_qty")
    return (non_null_keys(keyed, CKEY).groupBy(*JKEY)
            .agg(F.sum("dlv_qty").alias("dlv_qty"), doc_list("_dlv_no").alias("dlv_docs")))


def delivery_list(likp: DataFrame, lips: DataFrame, known: DataFrame | None, p: Params,
                  full: bool = False) -> DataFrame:
    """The delivery list (sales-unit quantity, B14).

    ``full=True`` is the unfiltered variant: no keep-first, no order filter,
    no zero filter and no batch de-duplication.
    """
    d = _joined(likp, lips, dedup=not full)
    if not full and known is not None:
        d = order_set_filter(d, known)
    d = (d.withColumn("VBELV", X.fill_if_blank("VBELV", "VGBEL"))
          .withColumn("POSNV", X.fill_if_blank("POSNV", "VGPOS"))
          .withColumn("qty_calc", X.signed("LFIMG")))
    if not full:
        d = d.where(X.nonzero("LFIMG", p))
        if p.list_batch_dedup:
            d = batch_child_dedup(d)
    return d.select(
        F.col("VKORG").alias("sales_org"), F.col("VBELN").alias("delivery_no"),
        F.col("POSNR").alias("delivery_item"), F.coalesce(F.col("LFART"), F.lit("")).alias("delivery_type"),
        F.col("UEPOS").alias("batch_parent_item"), F.col("UECHA").alias("batch_parent_split"),
        F.col("VBELV").alias("order_no"), F.col("POSNV").alias("order_item"), F.col("MATNR").alias("material"),
        F.col("ARKTX").alias("material_text"), F.col("KUNNR").alias("customer"),
        F.col("LFIMG").alias("qty_sales_unit"), F.col("LGMNG").alias("qty_base_unit"),
        X.delivery_unit().alias("qty_unit"), "qty_calc",
        F.col("MEINS").alias("base_unit"), F.col("VRKME").alias("sales_unit"), F.col("SHKZG").alias("dc_flag"),
        F.col("WERKS").alias("plant"), F.col("LGORT").alias("storage_loc"), F.col("ERDAT").alias("created_on"),
        F.col("LFDAT").alias("delivery_date"), F.col("CHARG").alias("batch"),
    )
