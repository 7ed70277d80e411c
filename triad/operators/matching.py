"""Three-way match (C9–C12, B26–B29), untested classes (C13) and control
totals (D24)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Params
from ..functions import exprs as X
from ..session import SCRATCH_CODEC, remove_folder, scratch_folder, shuffles_dropped, written
from .common import CKEY, JKEY, exclusion_set
from .company import tag_headers
from .deliveries import delivery_lines, delivery_pivot, known_orders
from .invoices import invoice_lines, invoice_pivot
from .orders import GRAIN_COLUMNS, material_grain, order_key_pivot, order_lines, order_pivot

MATCH_MEASURES = ["inv_qty", "inv_amt", "dlv_qty", "ord_qty", "ord_amt_lc", "ord_amt_fc"]


def match_figures() -> dict[str, Column]:
    """What the write of the matched rows counts by itself."""
    return {"rows_out": F.count(F.lit(1)), "negative_rows": F.count(F.when(F.col("is_negative"), 1))}


@dataclass
class Pivots:
    """The document pivots of one run (keyed on company, VKORG, VBELN, POSNR)."""

    grain: DataFrame       # order lines by material; order and order_key derive from it
    delivery: DataFrame    # D3 + D5
    invoice: DataFrame     # D4 + D5 + D6
    figures: dict = field(default_factory=dict)   # D24, counted while they were written
    tables: tuple = ()
    scratch: tuple = ()    # folders that only these pivots read
    lines: DataFrame | None = None   # the order lines of the grain, while it is not written

    NAMES = ("order", "order_key", "delivery", "invoice")

    @property
    def order(self) -> DataFrame:
        """Material grain."""
        return order_pivot(self.grain)

    @property
    def order_key(self) -> DataFrame:
        """Order-line grain (D2 + C10 + C11)."""
        return order_key_pivot(self.grain)

    def only(self, companies: DataFrame | None) -> "Pivots":
        """The pivots of some companies."""
        if companies is None:
            return self
        grain, delivery, invoice, lines = (d if d is None else d.join(companies, "company", "left_semi")
                                           for d in (self.grain, self.delivery, self.invoice, self.lines))
        return Pivots(grain, delivery, invoice, scratch=self.scratch, lines=lines)

    def figures_only(self) -> "Pivots":
        """The pivots for readers of quantities and amounts alone: descriptions, types and
        document numbers are null, so none are gathered when the pivots are written."""
        def cut(d: DataFrame, *text: str) -> DataFrame:
            return d.select(*[F.lit(None).cast(d.schema[c].dataType).alias(c) if c in text else F.col(c) for c in d.columns])

        return Pivots(cut(self.grain, "ARKTX", "AUART", "_auart_pos"), cut(self.delivery, "dlv_docs"), cut(self.invoice, "inv_type", "inv_docs"),
                      scratch=self.scratch, lines=None if self.lines is None else self.lines.drop("ARKTX", "AUART", "_ord"))

    def write(self, folder: str, control: bool = True) -> "Pivots":
        """Each pivot written once under ``folder``, bucketed and sorted on the match key into as
        many buckets as the session has shuffle partitions, and read again: the match and
        the untested classes then join bucket by bucket, without an exchange, and a
        lost executor repeats none of the work.  The order lines are written at
        material grain only; the order-line pivot folds up inside its bucket.  On the way they
        are written as they come from their headers and from their aggregation, so that the
        shuffles of each step are gone before those of the next are made.  The control figures are counted by the writes (invoice keys and total)
        and on the keys of the buckets (order lines of several materials), unless
        ``control`` is false.  What only the unwritten pivots read goes: use those returned."""
        spark = self.grain.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        seen, folders, read, tables = Observation(), [], {}, []

        def bucketed(name: str, df: DataFrame) -> None:
            table = f"pivot_{uuid.uuid4().hex}"
            with shuffles_dropped(spark):
                (df.write.bucketBy(buckets, *JKEY).sortBy(*JKEY).format("parquet").option("compression", SCRATCH_CODEC)
                 .option("path", f"{folder}/{name}").mode("overwrite").saveAsTable(table))
            read[name] = spark.table(table)
            tables.append(table)
            folders.append(f"{folder}/{name}")

        passed = [scratch_folder(spark, n) for n in ("order-lines", "grain")]
        grain = self.grain
        if self.lines is not None:
            grain = material_grain(written(self.lines, "order-lines", passed[0]))
            grain = grain.select(*[c if c in grain.columns else F.lit(None).cast(self.grain.schema[c].dataType).alias(c) for c in self.grain.columns])
        grain = written(grain, "grain", passed[1])
        remove_folder(spark, passed[0])
        bucketed("grain", grain.repartition(buckets, *JKEY))
        remove_folder(spark, passed[1])
        bucketed("delivery", self.delivery)
        for done in self.scratch:
            remove_folder(spark, done)
        invoice, figures = self.invoice, {}
        if control:
            total = F.sum(F.col("inv_amt").cast("decimal(38,2)"))
            invoice = invoice.observe(seen, F.count(F.lit(1)).alias("invoice_keys"), total.alias("invoice_total"))
        bucketed("invoice", invoice)
        if control:
            several = read["grain"].groupBy(*JKEY).count().where(F.col("count") > 1)
            with shuffles_dropped(spark):
                figures = {**seen.get, "multi_material_keys": several.count()}
        return Pivots(**read, figures=figures, tables=tuple(tables), scratch=tuple(folders))

    def release(self, remove: bool = False) -> None:
        """Forget the tables' names; the files stay in the run's folder, or go too (``remove``)
        where all that reads them is written."""
        spark = self.grain.sparkSession
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for folder in self.scratch if remove else ():
            remove_folder(spark, folder)

    def persist(self) -> "Pivots":
        """Keep the pivots (each read by the match *and* the untested classes)
        for the duration of one stage.  MEMORY_AND_DISK: a lost executor's blocks
        are recomputed from lineage; nothing is held on the driver."""
        from pyspark import StorageLevel
        for df in (self.grain, self.delivery, self.invoice):
            df.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        for df in (self.grain, self.delivery, self.invoice):
            df.unpersist()


def build_pivots(spark: SparkSession, t: dict[str, DataFrame], p: Params, tagged: dict[str, DataFrame] | None = None) -> Pivots:
    """Orders, deliveries and invoices of ``t`` (the six conformed tables); ``tagged``: the
    same with the headers' company, where the caller has it."""
    excl = exclusion_set(spark, p, t["VBAK"], t["VBRK"])
    t = tagged or tag_headers(t, p)
    lines = order_lines(t["VBAK"], t["VBAP"], excl, p)
    known = known_orders(t["VBAK"])
    scratch = scratch_folder(spark, "delivery-lines")
    dl = delivery_lines(t["LIKP"], t["LIPS"], known, p, batch_dedup=True, scratch=scratch)
    il = invoice_lines(t["VBRK"], t["VBRP"], excl, p, known)
    return Pivots(material_grain(lines), delivery_pivot(dl), invoice_pivot(il), scratch=(scratch,), lines=lines.select(*GRAIN_COLUMNS))


def three_way_match(pv: Pivots, p: Params) -> DataFrame:
    """Invoice pivot (driving side) ⟕ delivery pivot ⟕ order pivot on
    (VKORG, VBELN, POSNR); B26 fill + half-even rounding; B27 differences;
    B29 negative-invoice flag.  Keys are unique on every side, so the join
    never fans out; all three inputs arrive hash-partitioned on the key."""
    inv = pv.invoice
    dlv = pv.delivery.withColumn("_has_dlv", F.lit(True))
    ordk = pv.order_key.withColumn("_has_ord", F.lit(True))
    j = inv.join(dlv, JKEY, "left").join(ordk, JKEY, "left")
    m = j.select(
        *CKEY, "AUART", "inv_docs", "inv_type", "dlv_docs",
        *[X.round2(c).alias(c) for c in MATCH_MEASURES],
        "MATNR", "ARKTX",
        F.col("_has_dlv").isNull().alias("delivery_missing"),
        F.col("_has_ord").isNull().alias("order_missing"),
        F.coalesce(F.col("n_materials"), F.lit(0)).alias("n_materials"),
    )
    m = (m.withColumn("amt_diff", F.col("ord_amt_lc") - F.col("inv_amt"))
          .withColumn("od_qty_diff", F.col("ord_qty") - F.col("dlv_qty"))
          .withColumn("oi_qty_diff", F.col("ord_qty") - F.col("inv_qty"))
          .withColumn("di_qty_diff", F.col("dlv_qty") - F.col("inv_qty")))
    t = p.tolerance
    neg = (X.lt_tol("ord_qty", t) & X.lt_tol("dlv_qty", t) & (F.col("inv_amt") < -X.dec(t)))
    return m.withColumn("is_negative", neg)


def untested(pv: Pivots, p: Params) -> DataFrame:
    """Order pivot (material grain) ⟗ delivery pivot, without invoice.

    Class ``order_only`` (no delivery), ``order_delivery`` (both) or
    ``delivery_only`` (no order).  The order side is at material grain, so a
    delivery quantity repeats for every material of its order line (as in
    the process).  The invoiced keys leave both sides by left-anti joins on
    the same key before the full join, which then needs no exchange after it.
    """
    invoiced = pv.invoice.select(*JKEY)
    o = pv.order.join(invoiced, JKEY, "left_anti").withColumn("_has_ord", F.lit(True))
    d = pv.delivery.select(*CKEY, "dlv_qty", "dlv_docs").join(invoiced, JKEY, "left_anti").withColumn("_has_dlv", F.lit(True))
    j = o.join(d, JKEY, "full")
    cls = (F.when(F.col("_has_dlv").isNull(), F.lit("order_only"))
            .when(F.col("_has_ord").isNull(), F.lit("delivery_only"))
            .otherwise(F.lit("order_delivery")))
    return j.select(*CKEY, "MATNR", "AUART", "ord_amt_fc", "ord_amt_lc", "ord_qty", "dlv_qty", "dlv_docs",
                    cls.alias("class"))


def negative_invoices(matched: DataFrame) -> DataFrame:
    """Rows moved to the untested class ``negative_invoice``."""
    return matched.where("is_negative")


def main_rows(matched: DataFrame) -> DataFrame:
    """The tested rows: match result without the negative-invoice rows."""
    return matched.where(~F.col("is_negative"))


def source_totals(t: dict[str, DataFrame], p: Params, all_headers: dict[str, DataFrame] | None = None) -> DataFrame:
    """D24, source side: order and invoice headers left out as intercompany, and
    delivery headers that repeat a number (all but the first are left out).
    ``all_headers`` give the codes where ``t`` holds some companies only."""
    spark = t["VBAK"].sparkSession
    every = all_headers or t
    codes = exclusion_set(spark, p, every["VBAK"], every["VBRK"]).withColumnRenamed("code", "_sold_to")

    def excluded(d: DataFrame, col: str, name: str) -> DataFrame:
        hit = d.select(X.sold_to_norm(col).alias("_sold_to")).join(F.broadcast(codes), "_sold_to", "left_semi")
        return hit.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")

    repeated = t["LIKP"].groupBy("MANDT", "VBELN").agg((F.count(F.lit(1)) - 1).alias("k")).agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("n")).select(F.lit("d").alias("what"), "n")
    u = excluded(t["VBAK"], "KUNNR", "o").unionByName(excluded(t["VBRK"], "KUNAG", "i")).unionByName(repeated)
    return u.agg(*[F.sum(F.when(F.col("what") == w, F.col("n"))).alias(c) for w, c in (
        ("o", "order_headers_excluded"), ("i", "invoice_headers_excluded"), ("d", "duplicate_delivery_headers"))])


def control_totals(pv: Pivots, matched: DataFrame, t: dict[str, DataFrame] | None = None, p: Params | None = None) -> DataFrame:
    """One row of control figures for the match stage.

    rows out, invoice keys in, fan-out (rows out - invoice keys), negative
    rows, invoice total before rounding, order lines with several materials;
    with the source tables also :func:`source_totals`.
    One union + one global aggregate (partial sums per task), no joins.
    """
    z = F.lit(0).cast("bigint")
    zd = F.lit(0).cast("decimal(38,2)")
    a = pv.invoice.select(F.lit(1).cast("bigint").alias("k"), F.col("inv_amt").cast("decimal(38,2)").alias("amt"),
                          z.alias("r"), z.alias("n"), z.alias("mm"))
    b = matched.select(z.alias("k"), zd.alias("amt"), F.lit(1).cast("bigint").alias("r"),
                       F.col("is_negative").cast("bigint").alias("n"), z.alias("mm"))
    c = pv.order_key.select(z.alias("k"), zd.alias("amt"), z.alias("r"), z.alias("n"),
                            (F.col("n_materials") > 1).cast("bigint").alias("mm"))
    out = a.unionByName(b).unionByName(c).agg(
        F.sum("r").alias("rows_out"), F.sum("k").alias("invoice_keys"), F.sum("n").alias("negative_rows"),
        F.sum("amt").alias("invoice_total"), F.sum("mm").alias("multi_material_keys"))
    out = out.select("rows_out", "invoice_keys", (F.col("rows_out") - F.col("invoice_keys")).alias("fan_out"),
                     "negative_rows", F.col("invoice_total").cast("double").alias("invoice_total"),
                     "multi_material_keys")
    if t is None:
        return out
    more = source_totals(t, p)  # one row; joined on a constant
    return out.withColumn("_one", F.lit(1)).join(F.broadcast(more.withColumn("_one", F.lit(1))), "_one").drop("_one")


def observed_control(spark: SparkSession, figures: dict, sources: DataFrame) -> DataFrame:
    """D24 from the figures that the writes of the pivots and the matched rows counted."""
    out = spark.createDataFrame(
        [(figures["rows_out"], figures["invoice_keys"], figures["rows_out"] - figures["invoice_keys"], figures["negative_rows"],
          None if figures["invoice_total"] is None else float(figures["invoice_total"]), figures["multi_material_keys"], 1)],
        "rows_out bigint, invoice_keys bigint, fan_out bigint, negative_rows bigint, invoice_total double, multi_material_keys bigint, _one int")
    return out.join(F.broadcast(sources.withColumn("_one", F.lit(1))), "_one").drop("_one")
