"""Column expressions of the reconciliation.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; there is no Python UDF anywhere in the package.
Quantities and amounts are exact decimals end to end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BLANK_PARENT_VALUES, BLANK_REF_VALUES, NEGATIVE_SIGN_CODES, Params

# Working precision of base-unit quantities after unit conversion.
QTY_WORK = T.DecimalType(24, 6)
# Measures after the two-decimal rounding of the match stage.
MEASURE = T.DecimalType(24, 2)


def dec(v) -> Column:
    """A decimal literal with exactly the digits written."""
    d = Decimal(str(v))
    scale = max(0, -d.as_tuple().exponent)
    prec = max(len(d.as_tuple().digits), scale + 1)
    return F.lit(d).cast(T.DecimalType(max(prec, 1), scale))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_ref(c) -> Column:
    """B1: document reference is missing (null, '', NAN, 0, 000, 000000)."""
    return F.upper(F.trim(F.coalesce(_c(c), F.lit("")))).isin(*BLANK_REF_VALUES)


def blank_parent_ref(c) -> Column:
    """B2: batch-parent pointer is missing ('' / 0 / 000000)."""
    return F.trim(F.coalesce(_c(c), F.lit(""))).isin(*BLANK_PARENT_VALUES)


def fill_if_blank(c, fallback) -> Column:
    """Take ``fallback`` where ``c`` is blank (per column)."""
    return F.when(blank_ref(c), _c(fallback)).otherwise(_c(c))


def material_norm(c) -> Column:
    """Trimmed material; blank or all-zero material becomes ''."""
    t = F.trim(F.coalesce(_c(c), F.lit("")))
    return F.when(t.rlike("^0*$"), F.lit("")).otherwise(t)


def sold_to_norm(c) -> Column:
    """Trimmed sold-to code without leading zeros; empty becomes '0'."""
    t = F.ltrim(F.trim(F.coalesce(_c(c), F.lit(""))), F.lit("0"))
    return F.when(t == "", F.lit("0")).otherwise(t)


def sign(c) -> Column:
    """debit/credit sign; H and X are negative, anything else positive."""
    return F.when(F.upper(F.trim(_c(c))).isin(*NEGATIVE_SIGN_CODES), F.lit(-1)).otherwise(F.lit(1))


def _nonzero(c, eps: Decimal) -> Column:
    return F.abs(F.coalesce(_c(c), F.lit(0))) >= dec(eps)


def _factor_or_one(c, zero_is_one: bool) -> Column:
    f = F.coalesce(_c(c), dec(1))
    if zero_is_one:
        f = F.when(f == 0, dec(1)).otherwise(f)
    return f


def order_base_qty(p: Params) -> Column:
    """KLMENG when maintained, else KWMENG x UMVKZ / UMVKN.

    UMVKN 0/null counts as 1; UMVKZ null counts as 1 but 0 is kept.
    """
    conv = (F.coalesce(F.col("KWMENG"), dec(0)) * _factor_or_one("UMVKZ", False)
            / _factor_or_one("UMVKN", True))
    return F.when(F.col("KLMENG").isNotNull() & _nonzero("KLMENG", p.zero_eps),
                  F.col("KLMENG").cast(QTY_WORK)).otherwise(conv.cast(QTY_WORK))


def base_qty(base_col: str, sales_col: str, p: Params) -> Column:
    """Base-unit quantity when maintained, else sales quantity
    converted by UMVKN / UMVKZ (both 0/null count as 1).  No sign applied."""
    conv = (F.coalesce(F.col(sales_col), dec(0)) * _factor_or_one("UMVKN", True)
            / _factor_or_one("UMVKZ", True))
    return F.when(_nonzero(base_col, p.zero_eps), F.col(base_col).cast(QTY_WORK)).otherwise(conv.cast(QTY_WORK))


def order_date() -> Column:
    """Order date; the document date, else the creation date."""
    return F.coalesce(F.col("AUDAT"), F.col("ERDAT"))


def signed(c) -> Column:
    """An amount or quantity (missing = 0) with the debit/credit sign."""
    return F.coalesce(_c(c), F.lit(0)) * sign("SHKZG")


def invoice_order_key() -> tuple[Column, Column]:
    """AUBEL/AUPOS; when either is blank both come from VBELV/POSNV."""
    use_ref = blank_ref("AUBEL") | blank_ref("AUPOS")
    return (F.when(use_ref, F.col("VBELV")).otherwise(F.col("AUBEL")),
            F.when(use_ref, F.col("POSNV")).otherwise(F.col("AUPOS")))


def nonzero(c, p: Params) -> Column:
    """At least the zero threshold in size; missing is zero."""
    return _nonzero(c, p.zero_eps)


def order_type_kept(p: Params) -> Column:
    """The order type is not left out, and is the wanted one if one is set."""
    at = F.upper(F.trim(F.coalesce(F.col("AUART"), F.lit(""))))
    keep = ~at.isin(*[x.upper() for x in p.order_type_exclude]) if p.order_type_exclude else F.lit(True)
    return keep if p.order_type is None else keep & (at == p.order_type.upper())


def order_inv_diff() -> Column:
    """Order amount less invoice amount."""
    return F.col("ord_amt_lc") - F.col("inv_amt")


def in_period(c, period) -> Column:
    """Date within the closed month range (pushable range predicate);
    no period means every row."""
    if period is None:
        return F.lit(True)
    return _c(c).between(F.lit(period.first_day), F.lit(period.last_day))


def delivery_unit() -> Column:
    """VRKME, else MEINS, else ''."""
    return F.coalesce(F.nullif(F.trim(F.col("VRKME")), F.lit("")),
                      F.nullif(F.trim(F.col("MEINS")), F.lit("")), F.lit(""))


def round2(c) -> Column:
    """Missing -> 0, then two decimals half-even (numpy's round)."""
    return F.bround(F.coalesce(_c(c), F.lit(0)), 2).cast(MEASURE)


def lt_tol(c, t: Decimal) -> Column:
    return F.abs(_c(c)) < dec(t)


def posnr_norm(c) -> Column:
    """Line number normalised once on both sides of a lookup: numeric
    text -> 6-digit zero-padded, anything else trimmed as is."""
    t = F.trim(_c(c))
    n = t.try_cast("bigint")
    return F.when(n.isNull(), t).otherwise(F.lpad(n.cast("string"), 6, "0"))


def material_cleanup(c) -> Column:
    """Drop a trailing '.0' and zero-width characters from material
    numbers read back from external files."""
    return F.regexp_replace(F.regexp_replace(_c(c), "\u200b", ""), "\\.0+$", "")
