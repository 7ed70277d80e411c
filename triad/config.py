"""Run parameters and the fixed business values of the reconciliation.

Everything a user may change per run lives in :class:`Params` (an immutable
dataclass, passed explicitly — no module-level mutable state).  Values that
must equal the audited process for results to agree are listed once, below,
under FIXED VALUES.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the audited process; do not reorder or edit)
# ---------------------------------------------------------------------------

# Sold-to codes of group companies; orders (KUNNR) and invoices (KUNAG) whose
# sold-to party is one of these are intercompany and left out.
SOLD_TO_EXCLUDE = (
    "4000", "4010", "4040", "4090", "4100", "4110", "4120", "4130", "4140", "4150",
    "4170", "4180", "4220", "4294", "4300", "4310", "4350", "4390", "4410", "4460",
    "4470", "4510", "4520", "4530", "4540", "4580", "4610", "4620", "4670", "4680",
    "4730", "4740", "4750", "4770", "4780", "4790", "4800", "4810", "4820", "4830",
    "4840", "4870", "4900", "4990", "5010", "5020", "5030", "5050", "5060", "5080",
    "5100", "5140",
)
# Codes taken back out of the exclusion set (these sold-to parties are tested).
SOLD_TO_EXCLUDE_REMOVE = ("4480",)

# Order types left out of the untested summary.
ORDER_TYPE_EXCLUDE = ("AB", "ZTR", "ZFT", "ZRE", "ZCR", "ZDR", "ZFD")

# Text values that mean "no reference" on a document link (after trim+upper).
BLANK_REF_VALUES = ("", "NAN", "0", "000", "000000")
# Narrower set for the batch-parent pointers UEPOS / UECHA (after trim).
BLANK_PARENT_VALUES = ("", "0", "000000")
# Debit/credit indicator values that flip the sign of a quantity or amount.
NEGATIVE_SIGN_CODES = ("H", "X")

# Scenario id -> label as printed in the audit workpapers, and an English gloss.
SCENARIO_LABELS = (
    (1, "订单数量=发票≠交货单,订单金额<发票金额", "qty order=invoice<>delivery, amount order<invoice"),
    (2, "订单数量=发票≠交货单,订单金额>发票金额", "qty order=invoice<>delivery, amount order>invoice"),
    (3, "订单数量=发票≠交货单,无差异", "qty order=invoice<>delivery, amount equal"),
    (4, "订单数量≠发票≠交货单,订单金额<发票金额", "qty all differ, amount order<invoice"),
    (5, "订单数量≠发票≠交货单,订单金额>发票金额", "qty all differ, amount order>invoice"),
    (6, "订单数量≠发票≠交货单,无差异", "qty all differ, amount equal"),
    (7, "缺失发票 (无发票无开票金额), N/A", "missing invoice"),
    (8, "无差异,订单金额<发票金额", "qty all equal, amount order<invoice"),
    (9, "无差异,订单金额>发票金额", "qty all equal, amount order>invoice"),
    (10, "无差异,无差异", "fully matched"),
    (11, "订单数量=交货单≠发票,无差异", "qty order=delivery<>invoice, amount equal"),
    (12, "订单数量=交货单≠发票,订单金额<发票金额", "qty order=delivery<>invoice, amount order<invoice"),
    (13, "订单数量=交货单≠发票,订单金额>发票金额", "qty order=delivery<>invoice, amount order>invoice"),
    (14, "有发票、订单或发运单缺失,Not Test", "negative invoice, not tested"),
)
# Scenarios shown in the statistics (10 and 0 are computed but not reported).
REPORTED_SCENARIOS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13)
# Four-class roll-up of scenarios used by the group report.
SCENARIO_CLASSES = (
    ("none", (3, 10)),
    ("amount", (1, 2, 8, 9, 12, 13)),
    ("quantity", (6, 11)),
    ("both", (4, 5)),
)

# Column lists kept from each extract table.
KEY_FIELDS = {
    "VBAK": ["MANDT", "VBELN", "VKORG", "AUDAT", "ERDAT", "AUART", "KUNNR", "VKGRP", "VKBUR", "NETWR", "WAERK"],
    "VBAP": ["MANDT", "VBELN", "POSNR", "MATNR", "ARKTX", "KWMENG", "KLMENG", "UMVKZ", "UMVKN", "VRKME", "NETWR",
             "NETPR", "MEINS", "SHKZG", "RETPO", "WKURS", "WAERK", "WERKS", "LGORT", "VSTEL", "ERDAT", "AUDAT"],
    "LIKP": ["MANDT", "VBELN", "VKORG", "LFART"],
    "LIPS": ["MANDT", "VBELN", "POSNR", "UEPOS", "UECHA", "VBELV", "POSNV", "VGBEL", "VGPOS", "VKORG", "MATNR",
             "ARKTX", "KUNNR", "LFIMG", "LGMNG", "UMVKZ", "UMVKN", "MEINS", "VRKME", "NETWR", "NETPR", "SHKZG",
             "WERKS", "LGORT", "ERDAT", "LFDAT", "CHARG"],
    "VBRK": ["MANDT", "VBELN", "FKART", "VKORG", "BUKRS", "KUNRG", "KUNAG", "FKDAT", "NETWR", "WAERK", "BELNR",
             "GJAHR", "ERDAT"],
    "VBRP": ["MANDT", "VBELN", "POSNR", "VBELV", "POSNV", "AUBEL", "AUPOS", "MATNR", "ARKTX", "KUNNR", "BUKRS",
             "FKIMG", "FKLMG", "UMVKZ", "UMVKN", "VRKME", "NETWR", "AKKUR", "MWSBP", "SHKZG", "FKDAT", "BELNR",
             "GJAHR", "WAERK", "ERDAT"],
}
# Extra columns kept beyond the key-field lists (company split uses BUKRS_VF).
EXTRA_FIELDS = {"VBAK": ["BUKRS_VF"]}

# File-name patterns of the main tables (helper tables such as VBAK_VBRP_* excluded).
TABLE_FILE_GLOBS = {
    "VBAK": "VBAK_[0-9]*.TXT", "VBAP": "VBAP_[0-9]*.TXT", "LIKP": "LIKP_[0-9]*.TXT",
    "LIPS": "LIPS_[0-9]*.TXT", "VBRK": "VBRK_[0-9]*.TXT", "VBRP": "VBRP_[0-9]*.TXT",
}
# Field separator of the text extracts.
EXTRACT_SEP = "#|#"
# Rows per output file (spreadsheet-sized parts).
ROWS_PER_FILE = 980000

TABLES = ("VBAK", "VBAP", "LIKP", "LIPS", "VBRK", "VBRP")


@dataclass(frozen=True)
class Period:
    """Closed month range ``[year-m1, year-m2]`` on a date column."""

    year: int = 2025
    month_start: int = 1
    month_end: int = 12

    @property
    def first_day(self) -> _dt.date:
        return _dt.date(self.year, self.month_start, 1)

    @property
    def last_day(self) -> _dt.date:
        if self.month_end == 12:
            return _dt.date(self.year, 12, 31)
        return _dt.date(self.year, self.month_end + 1, 1) - _dt.timedelta(days=1)


@dataclass(frozen=True)
class Params:
    """All knobs of one reconciliation run (defaults = the audited process)."""

    invoice_period: Period | None = field(default_factory=Period)   # None: all dates
    order_period: Period | None = field(default_factory=Period)
    # Optional filters the documentation promises but the process does not apply.
    filter_order_period_in_match: bool = False
    order_type: str | None = None
    order_type_exclude: tuple[str, ...] = ORDER_TYPE_EXCLUDE
    sold_to_exclude: tuple[str, ...] = SOLD_TO_EXCLUDE
    sold_to_exclude_remove: tuple[str, ...] = SOLD_TO_EXCLUDE_REMOVE
    # Add the 4-digit company codes found in the data to the exclusion set.
    exclude_own_company_codes: bool = True
    tolerance: Decimal = Decimal("0.01")
    zero_eps: Decimal = Decimal("0.000001")
    unit_ratio: Decimal = Decimal("4")
    unit_ratio_tol: Decimal = Decimal("0.05")
    # Exchange rate used when WKURS is missing.
    missing_rate: Decimal = Decimal("1")
    tier_high: float = 80.0
    tier_mid: float = 60.0
    # Batch-child de-duplication: always on in matching, off by default in lists.
    list_batch_dedup: bool = False
    # Optional invoice filter to known order numbers (off in the process).
    invoice_order_filter: bool = False
    # Company dimension of every result: "bukrs" (company code via the
    # VKORG->BUKRS map) or "vkorg" (sales organisation).
    company_by: str = "bukrs"
    rows_per_file: int = ROWS_PER_FILE

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @property
    def static_exclusions(self) -> tuple[str, ...]:
        drop = set(self.sold_to_exclude_remove)
        return tuple(c for c in self.sold_to_exclude if c not in drop)


def fixture_params() -> Params:
    """Parameters of the sf fixtures: invoice period 1998, company = VKORG."""
    return Params(
        invoice_period=Period(1998, 1, 12),
        order_period=Period(1998, 1, 12),
        company_by="vkorg",
        exclude_own_company_codes=False,
    )
