"""Canonical typed schema of the six extract tables (type policy, A3)."""

from __future__ import annotations

from pyspark.sql import types as T

from ..config import EXTRA_FIELDS, KEY_FIELDS

AMOUNT = T.DecimalType(18, 2)
QTY = T.DecimalType(18, 3)
FACTOR = T.DecimalType(9, 0)
RATE = T.DecimalType(9, 5)

# column -> (type, value used when the cell is missing or unparsable)
# Amounts and sales-unit quantities default to 0 (as the loader did); base-unit
# quantities and conversion factors stay null so "not maintained" is visible.
_TYPED: dict[str, tuple[T.DataType, object]] = {
    "NETWR": (AMOUNT, 0), "NETPR": (AMOUNT, 0), "AKKUR": (AMOUNT, 0), "MWSBP": (AMOUNT, 0),
    "KWMENG": (QTY, 0), "LFIMG": (QTY, 0), "FKIMG": (QTY, 0),
    "KLMENG": (QTY, None), "LGMNG": (QTY, None), "FKLMG": (QTY, None),
    "UMVKZ": (FACTOR, None), "UMVKN": (FACTOR, None),
    # WKURS: a missing rate stays null and is read as Params.missing_rate.
    "WKURS": (RATE, None),
    "GJAHR": (T.IntegerType(), 0),
    "AUDAT": (T.DateType(), None), "ERDAT": (T.DateType(), None),
    "LFDAT": (T.DateType(), None), "FKDAT": (T.DateType(), None),
}


def column_type(col: str) -> T.DataType:
    return _TYPED.get(col, (T.StringType(), None))[0]


def column_default(col: str):
    return _TYPED.get(col, (T.StringType(), None))[1]


def table_columns(table: str) -> list[str]:
    return list(KEY_FIELDS[table]) + list(EXTRA_FIELDS.get(table, []))


def table_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c), True) for c in table_columns(table)])
