"""Report parameters, checked on the driver before any plan is built."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, fields
from datetime import datetime
from typing import Any

# A date parameter may be absent (None) or blank. A blank date arrives as this value.
BLANK_DATE = datetime(1900, 1, 1)

# The accepted texts of the two output parameters.
ORDER_BY_TRANSACTION = "TRN"
ORDER_BY_POST_DATE = "Post Date, Type then Transaction Number"
ORDER_BY_INVOICE_DATE = "Invoice Date, Type then Transaction Number"
ORDER_BY_TYPE = "Transaction Type then Transaction Number"
ORDER_BY_NUMBER = "Transaction Number then Transaction Type"
BRANCH_SUMMARY_LABELS = (
    "Transaction Branch",
    "Transaction Currency, Transaction Branch then Organization",
    "Transaction Currency, Transaction Branch then Organisation",
)

# Parameter names as callers of the stored report know them.
REPORT_ARGUMENTS = {
    "Period": "period",
    "Company": "company",
    "Branch": "branch",
    "OrgList": "accounts",
    "OrgGroupList": "account_groups",
    "BranchList": "branches",
    "CountryList": "countries",
    "ExCountryList": "excluded_countries",
    "SalesRepList": "sales_rep",
    "OverLimitOnly": "over_limit_only",
    "AgeingOption": "ageing_option",
    "Day1": "day1",
    "Day2": "day2",
    "Day3": "day3",
    "Day4": "day4",
    "AccountsRelationShip": "relationships",
    "ConsolidatedCategory": "consolidation_categories",
    "SalesRepRoll": "sales_rep_roles",
    "SummaryOnly": "summary_only",
    "LedgerType": "ledger",
    "AgedByInvoiceDate": "aged_by",
    "CurrencyList": "currencies",
    "IncludeDisbursement": "include_disbursement",
    "DisbursementTranOnly": "disbursement_only",
    "SettlementGroupList": "settlement_groups",
    "CreditRating": "credit_ratings",
    "ShowInInvoicedCurrency": "in_invoice_currency",
    "ShowLocalEquivalentTotal": "local_equivalent",
    "ShowAllTransactions": "all_transactions",
    "PaymentStatus": "payment_status",
    "TransactionTypeList": "transaction_types",
    "PostDateFrom": "post_date_from",
    "PostDateTo": "post_date_to",
    "DueDateFrom": "due_date_from",
    "DueDateTo": "due_date_to",
    "InvoiceDateFrom": "invoice_date_from",
    "InvoiceDateTo": "invoice_date_to",
    "NotInActiveBatchTranOnly": "not_in_active_batch_only",
    "GroupBy": "group_by",
    "OrderBy": "order_by",
    "OrgBranch": "org_branch",
    "ShowAddUser": "show_operator",
    "ShowOnlyAggregated": "posted_to_gl",
    "ShowLineAmounts": "line_amounts",
    "CurrentDateTime": "current_date_time",
    "OverdueTransactions": "overdue_only",
    "BranchManagementCode": "branch_management_code",
    "AgreedPaymentMethodList": "payment_methods",
    "ExcludeMatchedToFutureRECPAY": "exclude_future_matches",
    "FutureRECPAYNotInBalance": "future_matches_apart",
    "IncludeActiveBatchTran": "include_active_batch",
    "FilterNotActiveBatchTran": "excluded_batch_types",
    "ShowMatchStatusAndReason": "match_status_text",
}

_LISTS = (
    "accounts",
    "account_groups",
    "branches",
    "countries",
    "excluded_countries",
    "relationships",
    "consolidation_categories",
    "sales_rep_roles",
    "currencies",
    "settlement_groups",
    "credit_ratings",
    "transaction_types",
    "payment_methods",
    "excluded_batch_types",
)
_FLAGS = (
    "over_limit_only",
    "summary_only",
    "disbursement_only",
    "in_invoice_currency",
    "local_equivalent",
    "all_transactions",
    "not_in_active_batch_only",
    "show_operator",
    "line_amounts",
    "overdue_only",
    "exclude_future_matches",
    "future_matches_apart",
    "include_active_batch",
    "match_status_text",
)


@dataclass(frozen=True)
class AgeingDates:
    """Boundary dates of the ageing buckets. A missing boundary is None."""

    report_date: datetime
    current_start: datetime | None = None
    current_end: datetime | None = None
    p1_start: datetime | None = None
    p2_start: datetime | None = None
    p3_start: datetime | None = None
    p4_start: datetime | None = None
    p1_plus_start: datetime | None = None
    p2_plus_start: datetime | None = None
    p3_plus_start: datetime | None = None


def split_list(value: str | Iterable[Any] | None) -> tuple[Any, ...] | None:
    """A list parameter as a tuple, or None when it is blank and so switched off.

    Text is split at commas; blank parts do not count. Text of commas alone is a
    list without values, which is not the same as a blank list.
    """
    if value is None or value == "":
        return None
    if isinstance(value, str):
        return tuple(part.strip() for part in value.split(",") if part.strip())
    return tuple(value) or None


def is_on(value: Any) -> bool:
    return value is True or value == "Y"


@dataclass(frozen=True)
class ReportParams:
    """What to report. List parameters take a list or comma-separated text, flags take a bool or 'Y'."""

    company: Any
    ledger: str
    current_date_time: datetime
    branch: Any = None
    period: int | None = 0

    # account and transaction filters
    accounts: Any = None
    account_groups: Any = None
    branches: Any = None
    branch_management_code: str | None = None
    countries: Any = None
    excluded_countries: Any = None
    currencies: Any = None
    settlement_groups: Any = None
    relationships: Any = None
    consolidation_categories: Any = None
    credit_ratings: Any = None
    org_branch: str | None = None
    sales_rep: str | None = None
    sales_rep_roles: Any = None
    posted_to_gl: str | None = ""
    payment_methods: Any = None
    include_active_batch: Any = True
    not_in_active_batch_only: Any = False
    excluded_batch_types: Any = None
    disbursement_only: Any = False
    over_limit_only: Any = False
    overdue_only: Any = False

    # filters of the all-transactions listing only
    all_transactions: Any = False
    transaction_types: Any = None
    payment_status: str | None = None
    post_date_from: datetime | None = None
    post_date_to: datetime | None = None
    due_date_from: datetime | None = None
    due_date_to: datetime | None = None
    invoice_date_from: datetime | None = None
    invoice_date_to: datetime | None = None

    # ageing
    ageing_option: str = "PER"
    day1: int | None = 30
    day2: int | None = 60
    day3: int | None = 90
    day4: int | None = 120
    aged_by: str = "DUE"
    ageing_dates: AgeingDates | None = None

    # amounts and output
    in_invoice_currency: Any = False
    local_equivalent: Any = False
    line_amounts: Any = False
    future_matches_apart: Any = False
    exclude_future_matches: Any = False
    summary_only: Any = False
    group_by: str | None = None
    order_by: str | None = None
    show_operator: Any = False
    match_status_text: Any = False
    include_disbursement: Any = None  # accepted for callers' sake, has no effect

    # wall clock of the overdue test; the session's clock when not given
    now: datetime | None = None

    # behaviour switches
    future_match_all_companies: bool = False
    legacy_invoice_sort: bool = False
    country_office_scope: str = "global"
    literal_fanout: bool = False
    strict_contacts: bool = False
    exchange_rate_types: tuple[str, ...] | None = field(default=None)

    def __post_init__(self) -> None:
        for name in _LISTS:
            object.__setattr__(self, name, split_list(getattr(self, name)))
        for name in _FLAGS:
            value = getattr(self, name)
            # An absent one of these two is neither on nor off.
            absent = value is None and name in ("over_limit_only", "show_operator")
            object.__setattr__(self, name, None if absent else is_on(value))
        if self.ledger not in ("AR", "AP"):
            raise ValueError(f"ledger must be 'AR' or 'AP', not {self.ledger!r}")
        if self.current_date_time is None:
            raise ValueError("current_date_time is required")
        if self.country_office_scope not in ("global", "per_org"):
            raise ValueError("country_office_scope must be 'global' or 'per_org'")

    @classmethod
    def from_report_arguments(cls, arguments: dict[str, Any], **extra: Any) -> ReportParams:
        """Parameters from the names callers of the stored report use, with or without a leading '@'."""
        values: dict[str, Any] = {}
        for name, value in arguments.items():
            key = REPORT_ARGUMENTS.get(name.lstrip("@"))
            if key is None:
                raise ValueError(f"unknown report argument {name!r}")
            values[key] = value
        return cls(**values, **extra)

    @property
    def is_ar(self) -> bool:
        return self.ledger == "AR"

    @property
    def party_type(self) -> str:
        return "ARS" if self.is_ar else "APS"

    @property
    def today(self) -> datetime:
        return self.current_date_time.replace(hour=0, minute=0, second=0, microsecond=0)


assert set(REPORT_ARGUMENTS.values()) <= {f.name for f in fields(ReportParams)}
