"""Business configuration: code lists, cut-over dates and the rule tables.

Everything a finance team may change lives here as data; the functions in
``ledgerloom.functions`` turn it into Spark columns.  Every plan takes its
configuration as a parameter, so another set of companies needs no code.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class SourceRule:
    """Take ``source`` (from character ``start`` on) when every stated condition holds."""

    source: str
    companies: tuple[str, ...]
    since: date | None = None
    until: date | None = None
    on: date | None = None
    prefix: str | None = None
    start: int = 1


@dataclass(frozen=True)
class CarrierRule:
    """How a group of companies marks an invoice raised on behalf of another site.

    ``marker`` starting with ``prefix`` means another site delivered.  A marker
    of NULL is neither yes nor no, and the derived fields become ``Unknown``.
    """

    companies: tuple[str, ...]
    marker: str
    prefix: str
    site_length: int | None       # leading characters of the marker; None = all of it
    carried_source: str           # invoice number of the delivering site ...
    carried_start: int            # ... from this character on
    own_source: str               # invoice number when the company delivered itself
    intercompany_prefix: str      # customer element prefix of intercompany invoices


# Fixed values -------------------------------------------------------------
SITE_IDS = {
    "ALLENTOWN": "0",
    "BAS": "1",
    "MAI": "2",
    "MP": "4",
    "WAR": "13",
    "CLINTRAK": "99",
    "INDY": "20",
    "KOREA": "33",
    "JAPAN": "15",
    "SINGAPORE": "3",
    "CHINA": "7",
    "SUZHOU": "31",
    "HEG": "38",
}

EXCLUDED_DOCUMENT_CODES = (
    "DISPERSE", "MATCHING", "PCANCEL", "PINV", "PINVDBT", "RECEIPTS",
    "Y/E-PROC-BS", "CPAY", "CREC", "OBAL", "PCRN", "REVAL", "REVALR",
    "YE-PROC-BS", "PINV_XL", "PINVDBT_XL", "PINV2", "PINV1", "ACCLTBI",
    "ACCLTBIREV", "ACCREV", "ACCRUAL", "CORRECTIVE", "PCRNIC", "PINVIC",
    "RECLASS", "REVACC", "REVERSAL", "JGEN", "JGENREV", "JREVGEN",
)

UNKNOWN = "Unknown"
PAID_STATUS = 665
CDC_DELETE = "D"
FIRST_DAY = date(2019, 1, 1)

AR_ACCOUNT_PREFIX = "021"
AR_EXTRA_ACCOUNT = "28020"
AR_EXTRA_COMPANIES = ("ALLENTOWN", "MP", "CLINTRAK", "INDY")

CARRIER_RULES = (
    CarrierRule(("BAS", "WAR"), "ref5", "PT", 6, "ref5", 8, "docnum", "ICOM"),
    CarrierRule(("ALLENTOWN", "CLINTRAK", "MP"), "el4", "X", None, "ref5", 1, "ref1", "X"),
    CarrierRule(("MAI",), "ref3", "PT", 6, "ref3", 8, "ref1", "IF"),
)

AR_INVOICE_NUMBER = (
    SourceRule("ref1", ("ALLENTOWN", "MAI", "CHINA", "SINGAPORE", "CLINTRAK", "MP")),
    SourceRule("ref5", ("JAPAN", "SUZHOU")),
)
AR_PURCHASE_ORDER = (SourceRule("ref2", ("CHINA",)), SourceRule("ref3", ("WAR",)))
AR_PROTOCOL = (SourceRule("ref3", ("JAPAN", "SUZHOU")),)
AR_JOB_FROM_REF3 = "BAS"

REVENUE_INVOICE_NUMBER = (
    SourceRule("ref1", ("ALLENTOWN", "MAI", "CHINA", "CLINTRAK", "MP", "INDY")),
    SourceRule("head_number", ("BAS", "WAR", "HEG")),
    SourceRule("ref1", ("SINGAPORE",), prefix="CN", start=3),
    SourceRule("ref1", ("KOREA", "JAPAN", "SUZHOU")),
)
REVENUE_PURCHASE_ORDER = (
    SourceRule("ref2", ("SUZHOU",)),
    SourceRule("ref3", ("WAR",), since=date(2020, 11, 10)),
    SourceRule("ref2", ("KOREA",), until=date(2024, 7, 12)),
    SourceRule("ref3", ("KOREA",), on=date(2024, 7, 23)),
    SourceRule("ref2", ("JAPAN",), until=date(2024, 7, 31)),
    SourceRule("ref2", ("JAPAN",), on=date(2024, 8, 20)),
)
REVENUE_PROTOCOL = (
    SourceRule("ref3", ("SUZHOU",)),
    SourceRule("ref3", ("KOREA",), until=date(2024, 7, 12)),
    SourceRule("ref3", ("JAPAN",), until=date(2024, 7, 31)),
    SourceRule("ref3", ("JAPAN",), on=date(2024, 8, 20)),
)
REVENUE_ACCOUNT_PREFIX = "4"
REVENUE_ACCOUNT_RANGE = ("23160", "23180")
REVENUE_EXTRA_ACCOUNT = "24300"
REVENUE_EXTRA_COMPANIES = ("BAS", "WAR")
RECHARGE_COMPANY = "MAI"
RECHARGE_TEXT = "Recharges"
FOREIGN_JOB_COMPANIES = ("ALLENTOWN", "MP", "INDY", "CLINTRAK")
FOREIGN_JOB_PREFIX = "X"

SITE_FIELD = "ServiceDeliverySite"
INVOICE_FIELD = "ServiceDeliverySiteInvoiceNumber"

CREDIT_NOTE_MARK = "CR"
CANCEL_MARK = "cancel"
OWN_WAREHOUSE_KEY = "WARWAR"
OWN_WAREHOUSE_PREFIX = "WAR-"
CORRECTED_SUFFIX = "A"
COMPANY_DISPLAY = {"KOREA": "SOUTH KOREA"}
SITE_DISPLAY_PATTERN = ("MAI", "HORSHAM")

PASS_THROUGH_BY_INITIAL = "ALLENTOWN"
PASS_THROUGH_BY_CUSTOMER = ("MAI", "BAS")
PASS_THROUGH_MARKS = ("X", "x")
PASS_THROUGH_COMPANY = "BAS"
PASS_THROUGH_KEYS = ("BASD4199", "MAID4400")
SOURCE_NAME = "CODA"

REKEY_TYPE = "pass-through"
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ReceivablesConfig:
    site_ids: dict = field(default_factory=lambda: dict(SITE_IDS))
    excluded_codes: tuple[str, ...] = EXCLUDED_DOCUMENT_CODES
    first_day: date = FIRST_DAY
    account_prefix: str = AR_ACCOUNT_PREFIX
    paid_status: int = PAID_STATUS
    exact_amounts: bool = True
    carriers: tuple[CarrierRule, ...] = CARRIER_RULES
    invoice_number: tuple[SourceRule, ...] = AR_INVOICE_NUMBER
    purchase_order: tuple[SourceRule, ...] = AR_PURCHASE_ORDER
    protocol: tuple[SourceRule, ...] = AR_PROTOCOL
    job_from_ref3: str = AR_JOB_FROM_REF3

    @property
    def companies(self) -> tuple[str, ...]:
        return tuple(self.site_ids)


@dataclass(frozen=True)
class RevenueConfig:
    site_ids: dict = field(default_factory=lambda: dict(SITE_IDS))
    excluded_codes: tuple[str, ...] = EXCLUDED_DOCUMENT_CODES
    first_day: date = FIRST_DAY
    paid_status: int = PAID_STATUS
    exact_amounts: bool = True
    customer_prefix: str = AR_ACCOUNT_PREFIX
    customer_extra_account: str = AR_EXTRA_ACCOUNT
    customer_extra_companies: tuple[str, ...] = AR_EXTRA_COMPANIES
    account_prefix: str = REVENUE_ACCOUNT_PREFIX
    account_range: tuple[str, str] = REVENUE_ACCOUNT_RANGE
    extra_account: str = REVENUE_EXTRA_ACCOUNT
    extra_companies: tuple[str, ...] = REVENUE_EXTRA_COMPANIES
    recharge_company: str = RECHARGE_COMPANY
    recharge_text: str = RECHARGE_TEXT
    foreign_job_companies: tuple[str, ...] = FOREIGN_JOB_COMPANIES
    foreign_job_prefix: str = FOREIGN_JOB_PREFIX
    global_identifier: tuple[SourceRule, ...] = AR_INVOICE_NUMBER
    invoice_number: tuple[SourceRule, ...] = REVENUE_INVOICE_NUMBER
    purchase_order: tuple[SourceRule, ...] = REVENUE_PURCHASE_ORDER
    protocol: tuple[SourceRule, ...] = REVENUE_PROTOCOL


@dataclass(frozen=True)
class KeyConfig:
    """Names and marks that the reconciliation keys are made with."""

    company_display: dict = field(default_factory=lambda: dict(COMPANY_DISPLAY))
    site_display_pattern: tuple[str, str] = SITE_DISPLAY_PATTERN
    cancel_mark: str = CANCEL_MARK
    corrected_suffix: str = CORRECTED_SUFFIX
    unknown: str = UNKNOWN
    own_warehouse_key: str = OWN_WAREHOUSE_KEY
    own_warehouse_prefix: str = OWN_WAREHOUSE_PREFIX


@dataclass(frozen=True)
class ClassifyConfig:
    """Companies, customers and marks of pass-through revenue."""

    by_initial: tuple[str, ...] = (PASS_THROUGH_BY_INITIAL,)
    by_customer: tuple[str, ...] = PASS_THROUGH_BY_CUSTOMER
    marks: tuple[str, ...] = PASS_THROUGH_MARKS
    company: str = PASS_THROUGH_COMPANY
    keys: tuple[str, ...] = PASS_THROUGH_KEYS
    source_name: str = SOURCE_NAME
