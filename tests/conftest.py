"""Shared test fixtures: one local session and small hand-made SAP tables."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from triad.config import TABLES, Params, Period  # noqa: E402
from triad.sources.extract import conform  # noqa: E402
from triad.sources.schema import table_columns  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from triad.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="triad-tests", driver_memory="8g")
    yield s
    s.stop()


def edge_params(**kw) -> Params:
    """Parameters for hand-made rows: period 2025, company = sales org."""
    base = Params(invoice_period=Period(2025, 1, 12), order_period=Period(2025, 1, 12),
                  company_by="vkorg", exclude_own_company_codes=False)
    return base.with_(**kw)


def make_tables(spark, **rows) -> dict:
    """Six conformed tables from lists of dicts of text cells (file order =
    list order); tables not given are empty."""
    out = {}
    for table in TABLES:
        cols = table_columns(table)
        data = rows.get(table.lower(), [])
        tuples = [tuple(r.get(c) for c in cols) + (i,) for i, r in enumerate(data)]
        schema = ", ".join(f"`{c}` string" for c in cols) + ", _n int"
        raw = spark.createDataFrame(tuples, schema)
        out[table] = conform(raw, table, order_cols=["_n"])
    return out


def doc_set(n: int, ord_qty="10", dlv_qty="10", inv_qty="10", ord_amt="100.00", inv_amt="100.00",
            vkorg="1000", **over) -> dict[str, list[dict]]:
    """One order line with one delivery line and one invoice line, linked the
    ordinary way (delivery by VBELV/POSNV, invoice by AUBEL/AUPOS).  ``over``
    replaces cells as ``<table>_<COL>=value``."""
    o, d, i = f"{n:010d}", f"8{n:09d}", f"9{n:09d}"
    t = {
        "vbak": {"MANDT": "100", "VBELN": o, "VKORG": vkorg, "AUDAT": "20250105", "AUART": "ZOR",
                 "KUNNR": "0000100001", "NETWR": ord_amt},
        "vbap": {"MANDT": "100", "VBELN": o, "POSNR": "000010", "MATNR": "M1", "ARKTX": "thing",
                 "KWMENG": ord_qty, "KLMENG": ord_qty, "UMVKZ": "1", "UMVKN": "1", "NETWR": ord_amt, "WKURS": "1"},
        "likp": {"MANDT": "100", "VBELN": d, "VKORG": vkorg, "LFART": "LF"},
        "lips": {"MANDT": "100", "VBELN": d, "POSNR": "000010", "UEPOS": "000000", "UECHA": "000000",
                 "VBELV": o, "POSNV": "000010", "VGBEL": o, "VGPOS": "000010",
                 "LFIMG": dlv_qty, "LGMNG": dlv_qty, "UMVKZ": "1", "UMVKN": "1"},
        "vbrk": {"MANDT": "100", "VBELN": i, "VKORG": vkorg, "BUKRS": "5000", "KUNAG": "0000100001",
                 "FKART": "F2", "FKDAT": "20250110"},
        "vbrp": {"MANDT": "100", "VBELN": i, "POSNR": "000010", "VBELV": d, "POSNV": "000010", "AUBEL": o,
                 "AUPOS": "000010", "FKIMG": inv_qty, "FKLMG": inv_qty, "UMVKZ": "1", "UMVKN": "1",
                 "NETWR": inv_amt, "SHKZG": "S", "FKDAT": "20250110"},
    }
    for k, v in over.items():
        table, col = k.split("_", 1)
        if v is None:
            t[table].pop(col, None)
        else:
            t[table][col] = v
    return {k: [v] for k, v in t.items()}


def merge_sets(*sets) -> dict[str, list[dict]]:
    out: dict[str, list[dict]] = {}
    for s in sets:
        for k, v in s.items():
            out.setdefault(k, []).extend(v)
    return out
