"""Post-hoc check of zero-order-quantity rows.

For every detail row of scenario 4 or 5 ("differences everywhere") whose
order quantity is about 0, decide why:

1. the key is a real order line in VBAP -> quantity there non-zero / zero
   (summed base quantity over all its rows);
2. else the key is a delivery line; its order reference (VGBEL/VGPOS, else
   VBELV/POSNV) leads to an order line with a non-zero KLMENG;
3. else not found (flag: every invoice line pointing at the key has a blank
   AUBEL, so the invoice was keyed by a delivery number).

All keys are checked (no sample) with three left joins on normalised
line numbers, then one CASE — no per-key driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from ..session import written

#: Up to so many keys the tables are cut to them before they are aggregated.
FEW_KEYS = 1_000_000

VERDICTS = ("order_qty_nonzero", "order_qty_zero", "delivery_no_order_qty_nonzero", "not_found_or_zero")


def zero_order_keys(detail_rows: DataFrame, p: Params) -> DataFrame:
    """Distinct (VKORG, VBELN, POSNR) of scenario 4/5 rows with |order qty| < t."""
    z = detail_rows.where(F.col("scenario").isin(4, 5) & X.lt_tol("ord_qty", p.tolerance))
    return z.select("VKORG", "VBELN", "POSNR").distinct()


def sample_hash(seed: int = 42) -> Column:
    """A seeded multiplicative hash of the key, in plain integer arithmetic
    (the same value in any SQL engine), used to pick a reproducible sample."""
    v = F.coalesce(F.col("VBELN").try_cast("bigint"), F.lit(0)) % 2147483647
    n = F.coalesce(F.col("POSNR").try_cast("bigint"), F.lit(0)) % 2147483647
    return (v * 48271 + n * 16807 + F.lit(seed)) % 2147483647


def sample_keys(keys: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """F5 (optional): a deterministic sample of at most ``n`` keys, the
    smallest by :func:`sample_hash` (ties by key) — the sampling operator is
    the feature here.  Spark plans it as a per-partition top-n and a merge of
    the partial tops, never a full sort."""
    return keys.orderBy(sample_hash(seed), "VKORG", "VBELN", "POSNR").limit(n)


def verify_lookup(detail_rows: DataFrame, t: dict[str, DataFrame], p: Params,
                  keys: DataFrame | None = None) -> DataFrame:
    """C14: the keys come first.  Where they are few, every table is cut to them by a semi
    join (which the runtime Bloom filter pushes into the scan) before it is aggregated;
    many keys reach most rows, so the tables are then aggregated as they are.  Each table
    is read and aggregated once: VBAP for the keys and for the orders that delivery lines
    lead to, VBRP for both of its references.  The orders of the delivery lines are looked
    up there, where the rows are narrow, and so are the invoices; what is joined to the
    keys is written first, so AQE sees its size and splits hot keys."""
    keys = keys if keys is not None else zero_order_keys(detail_rows, p)
    k = written(keys.select("VKORG", "VBELN", "POSNR", X.posnr_norm("POSNR").alias("_pn")), "verify-keys")
    few = k.limit(FEW_KEYS + 1).count() <= FEW_KEYS
    lines = k.select(F.col("VBELN").alias("_v"), F.col("_pn").alias("_p")).distinct()

    def reached(df: DataFrame, by: DataFrame, on: list[str]) -> DataFrame:
        return df.join(by, on, "left_semi") if few else df

    # delivery line -> its order reference (first row per delivery line)
    ref_v = F.when(X.blank_ref("VGBEL"), F.col("VBELV")).otherwise(F.col("VGBEL"))
    ref_p = F.when(X.blank_ref("VGPOS"), F.col("POSNV")).otherwise(F.col("VGPOS"))
    lips = t["LIPS"].select(F.trim(F.col("VBELN")).alias("_v"), X.posnr_norm("POSNR").alias("_p"),
                            F.trim(ref_v).alias("ord_vbeln"), X.posnr_norm(ref_p).alias("ord_posnr"), "_ord")
    dref = reached(lips, lines, ["_v", "_p"]).groupBy("_v", "_p").agg(
        F.min_by(F.struct("ord_vbeln", "ord_posnr"), "_ord").alias("_o")).select("_v", "_p", "_o.*")
    dref = written(dref, "verify-references")
    # order lines of the keys and of the references: summed base quantity; first row's
    vbap = t["VBAP"].select(F.trim(F.col("VBELN")).alias("_v"), X.posnr_norm("POSNR").alias("_p"), "KLMENG", "_ord")
    if few:
        lines = lines.unionByName(dref.select(F.col("ord_vbeln").alias("_v"), F.col("ord_posnr").alias("_p"))).distinct()
    vsum = reached(vbap, lines, ["_v", "_p"]).groupBy("_v", "_p").agg(
        F.sum(F.coalesce(F.col("KLMENG"), F.lit(0))).alias("klmeng_sum"), F.min_by("KLMENG", F.col("_ord")).alias("klmeng_first"))
    vsum = written(vsum, "verify-orders")
    dref = dref.join(vsum.select(F.col("_v").alias("ord_vbeln"), F.col("_p").alias("ord_posnr"),
                                 F.col("klmeng_first").alias("ord_klmeng")), ["ord_vbeln", "ord_posnr"], "left")
    dref = written(dref, "verify-referenced")
    # invoices pointing at the key by VBELV or AUBEL: all with blank AUBEL?
    aub = F.trim(F.coalesce(F.col("AUBEL"), F.lit("")))
    refs = t["VBRP"].select(F.explode(F.array(F.trim(F.col("VBELV")), F.trim(F.col("AUBEL")))).alias("VBELN"), aub.alias("_a"))
    inv = reached(refs, k.select("VBELN").distinct(), ["VBELN"]).groupBy("VBELN").agg(
        (F.bool_and(F.col("_a") == "") | F.bool_and(F.col("_a") == "0")).alias("aubel_blank"))
    inv = written(inv, "verify-invoices")
    j = k.join(inv, "VBELN", "left")
    j = j.join(vsum.select(F.col("_v").alias("VBELN"), F.col("_p").alias("_pn"), "klmeng_sum"), ["VBELN", "_pn"], "left")
    j = j.join(dref.withColumnsRenamed({"_v": "VBELN", "_p": "_pn"}), ["VBELN", "_pn"], "left")
    eps = X.dec(p.zero_eps)
    verdict = (F.when(F.col("klmeng_sum").isNotNull() & (F.abs(F.col("klmeng_sum")) >= eps), F.lit(VERDICTS[0]))
                .when(F.col("klmeng_sum").isNotNull(), F.lit(VERDICTS[1]))
                .when(F.col("ord_klmeng").isNotNull() & (F.abs(F.col("ord_klmeng")) >= eps), F.lit(VERDICTS[2]))
                .otherwise(F.lit(VERDICTS[3])))
    return j.select("VKORG", "VBELN", "POSNR", verdict.alias("verdict"), "klmeng_sum", "ord_vbeln", "ord_posnr",
                    "ord_klmeng", F.coalesce(F.col("aubel_blank"), F.lit(False)).alias("aubel_blank"))


def verify_summary(result: DataFrame) -> DataFrame:
    """Rows per verdict."""
    return result.groupBy("verdict").agg(F.count(F.lit(1)).alias("rows"))
