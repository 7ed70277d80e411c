"""The variants of the fixture hold the rows that their queries are there for."""

from __future__ import annotations

import pytest
from compare import duck
from conftest import SF_SMALL

from triad.plans import catalog

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_units_of_all_kinds(con):
    rows = con.execute(f"SELECT DISTINCT qty_unit FROM ({SQL['b21_delivery_unit_varied']})").fetchall()
    assert {r[0] for r in rows} == {"ST", "KG", ""}


def test_line_numbers_change_and_letters_stay(con):
    changed, letters = con.execute(
        "SELECT count(*) FILTER (WHERE POSNR <> posnr_norm), count(*) FILTER (WHERE posnr_norm LIKE 'A%' AND POSNR = posnr_norm) "
        f"FROM ({SQL['b37_posnr_varied']})").fetchone()
    assert changed > 0 and letters > 0


def test_materials_lose_leftovers_only(con):
    leftover, fraction = con.execute(
        "SELECT count(*) FILTER (WHERE MATNR LIKE '%.0' OR MATNR LIKE '%.00' OR contains(MATNR, '​')), "
        f"count(*) FILTER (WHERE MATNR LIKE '%.05') FROM ({SQL['b38_material_cleanup_varied']})").fetchone()
    assert leftover == 0 and fraction > 0


def test_children_go_by_either_pointer(con):
    """Children of either pointer are dropped, and children of parents without quantity stay."""
    kept = con.execute("SELECT count(*) FILTER (WHERE UEPOS NOT IN ('', '0', '000000')), count(*) FILTER (WHERE UECHA NOT IN ('', '0', '000000')) "
                       f"FROM ({SQL['c8_batch_children_varied']})").fetchone()
    dropped = con.execute(f"SELECT count(*) FROM ({SQL['c8_dropped_children_varied']})").fetchone()[0]
    assert dropped > 0 and min(kept) > 0


def test_all_dates_add_rows(con):
    for name in ("c3_invoice_lines", "b29_negative_invoice", "d4_invoice_pivot"):
        year, whole = (con.execute(f"SELECT count(*) FROM ({SQL[n]})").fetchone()[0] for n in (name, f"{name}_all_dates"))
        assert whole > year
