"""The summaries: transactions are summed per account first, then meet the account attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.ageing import BUCKETS, LOCAL_SUFFIX, bucket_conditions
from duebook.functions.columns import MONEY, divide_money
from duebook.operators.accounts import ALL_PARTS, COMPANY, COUNTRY, CREDIT, SETTLEMENT, STAFF, account_profile
from duebook.operators.currency import with_period_end_rate, with_revaluation
from duebook.operators.headers import is_overdue, overdue
from duebook.operators.transactions import disbursement_kept, ledger_transactions
from duebook.params import BRANCH_SUMMARY_LABELS, ReportParams
from duebook.plans.context import RunContext
from duebook.plans.detail import fan_out_lines, join_profile, with_invoice_term, with_term_lists
from duebook.sources.tables import Tables

# Summary labels, the columns each groups by beside type and currency, and the account parts needed.
LISTING_SUMMARIES = {
    "Transaction Type": ((), ()),
    "Consolidation Category": (("ConsolidationCategory",), ()),
    "Accounts Relationship": (("ARCategory",), ()),
    "Organisation Branch": (("OrgBranchCode", "OrgBranchName"), (COMPANY,)),
    "Transaction Branch": (("BranchCode", "CountryCode", "TranBranchName"), (COUNTRY,)),
    "Sales Rep": (("SalesRep", "SalesRepName"), (STAFF,)),
    "Credit Controller": (("CreditController", "CreditControllerName"), (STAFF,)),
    "Customer Service Rep": (("CustomerService", "CustomerServiceName"), (STAFF,)),
    "Settlement Group": (("SettlementCode", "SettlementName"), (SETTLEMENT,)),
    "Debtor Group": (("AccountGroup",), (COMPANY,)),
    "Creditor Group": (("AccountGroup",), (COMPANY,)),
}
TYPE_KEYS = ("TransactionType", "TransactionTypeDesc", "CurrencyCode")
LISTING_SUMS = ("OSTotal", "InvoiceTotal", "InvoiceExTax", "TaxAmount", "LineInvoiceExTaxAmount", "LineTaxAmount")

AGEING_SUMS = (
    *BUCKETS,
    "DSBCharge",
    "Balance",
    *(name + LOCAL_SUFFIX for name in BUCKETS),
    "BalanceInLocal",
    "MatchedInFuturePeriodInInvoiceCurrency",
    "MatchedInFuturePeriodInLocalCurrency",
    "RevaluedLocalEquivalent",
    "LossOnRevaluation",
    "GainOnRevaluation",
)
# What the ageing summary groups by, beside currency, rate and branch.
AGEING_KEYS = (
    "AccountCode",
    "AccountName",
    "CreditLimit",
    "OrgBranchCode",
    "AccountGroup",
    "SalesRep",
    "CustomerService",
    "CreditController",
    "IsOverLimit",
    "ConsolidationCategory",
    "ARCategory",
    "SettlementCode",
    "CountryCode",
    "CountryName",
    "OrgBranchName",
    "SalesRepName",
    "CreditControllerName",
    "CustomerServiceName",
    "SettlementName",
    "ContactPhoneNo",
    "ARUseSettlementGroupCreditLimit",
    "SettlementGroupCreditLimit",
    "SettlementGroupOutstandingAmount",
    "SettlementGroupOverCreditLimit",
    "AdditionalCompanyName",
)


def null_amounts(names) -> dict:
    return {c: F.lit(None).cast(MONEY) for c in names}


def listing_summary(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Totals, counts and averages of the listing by type and currency, and by one more attribute."""
    if p.group_by not in LISTING_SUMMARIES:
        raise ValueError(f"unknown summary {p.group_by!r}")
    extra, parts = LISTING_SUMMARIES[p.group_by]
    parts = frozenset(parts) | ({CREDIT} if p.over_limit_only else frozenset())
    profile = account_profile(tables, p, ctx, parts)
    rows = ledger_transactions(tables, p, ctx, detail=False).filter(disbursement_kept(p))
    rows = fan_out_lines(overdue(rows, p), profile, p)

    summed = [c for c in LISTING_SUMS if p.line_amounts or not c.startswith("Line")]
    branch = [c for c in ("BranchCode", "TranBranchName") if c in extra]
    per_account = rows.groupBy("AccountPK", *branch, *TYPE_KEYS).agg(
        *[F.sum(c).alias(c) for c in summed], F.count(F.lit(1)).alias("rows")
    )
    sums = (
        join_profile(per_account, profile, p)
        .groupBy(*TYPE_KEYS, *extra)
        .agg(*[F.sum(c).alias(c) for c in summed], F.sum("rows").alias("NoOfTransactions"))
    )
    sums = sums.withColumns(null_amounts(c for c in LISTING_SUMS if c not in summed))
    count = F.col("NoOfTransactions")
    sums = sums.withColumns(
        {
            "LinesSum": F.col("LineInvoiceExTaxAmount") + F.col("LineTaxAmount"),
            "FXAvg": divide_money(F.col("OSTotal"), count),
            "LocalAvg": divide_money(F.col("InvoiceTotal"), count),
        }
    )
    amounts = ["OSTotal", "InvoiceTotal", "InvoiceExTax", "TaxAmount"]
    lines = ["LineInvoiceExTaxAmount", "LineTaxAmount", "LinesSum"]
    counts = [*TYPE_KEYS, "NoOfTransactions", "FXAvg", "LocalAvg"]
    order = [*amounts, *counts, *lines, *extra] if extra else [*amounts, *lines, *counts]
    return sums.select(*order)


def listing_summary_order(p: ReportParams) -> list[str]:
    """By type and currency, then by what else is told apart; these are the groups, so there are no ties."""
    return ["TransactionType", "CurrencyCode", *LISTING_SUMMARIES[p.group_by][0], "TransactionTypeDesc"]


def ageing_sums(p: ReportParams, ctx: RunContext) -> list[str]:
    """The amounts of the ageing summary that can have a value at all."""
    filled = bucket_conditions(p, ctx.dates)
    never = {c for c in BUCKETS if c not in filled}
    never |= {c + LOCAL_SUFFIX for c in BUCKETS if c in never or not p.local_equivalent}
    if not p.is_ar:
        never.add("DSBCharge")
    if not p.future_matches_apart:
        never |= {"MatchedInFuturePeriodInInvoiceCurrency", "MatchedInFuturePeriodInLocalCurrency"}
    return [c for c in AGEING_SUMS if c not in never]


def marked_rows(df: DataFrame, p: ReportParams) -> DataFrame:
    """Mark account codes where some sum by code and limit exceeds the limit.

    Rows are sums per account here, so a window never holds an account's transactions.
    Accounts without a code are never marked and are spread by their key. One shuffle
    serves both windows.
    """
    if p.over_limit_only is not False:
        return df.withColumn("IsOverLimit", F.lit(None).cast("string"))
    unknown = F.when(F.col("AccountCode").isNull(), F.col("AccountPK"))
    by_limit = Window.partitionBy("AccountCode", unknown, "CreditLimit")
    by_code = Window.partitionBy("AccountCode", unknown)
    df = df.repartition("AccountCode", unknown)
    df = df.withColumn("exceeded", F.sum("limit_balance").over(by_limit) > F.col("CreditLimit"))
    over = F.max(F.coalesce("exceeded", F.lit(False))).over(by_code) & F.col("AccountCode").isNotNull()
    return df.withColumn("IsOverLimit", F.when(over, "*")).drop("exceeded")


def listed_terms():
    """Distinct trimmed terms of a group, comma-separated, in their own order."""
    return F.array_join(F.array_sort(F.collect_set(F.trim("InvoiceTerm"))), ",")


def average_rate(ctx: RunContext):
    """Ratio of local to reported balance, or its inverse; none if either is zero."""
    local, balance = F.col("BalanceInLocal"), F.col("Balance").cast("decimal(21,6)")
    ratio = local / balance if ctx.reciprocal_rates else balance / local
    return F.when((local != 0) & (F.col("Balance") != 0), ratio)


def ageing_summary(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Balances, buckets, revaluation and credit by account, and by currency or branch if asked for."""
    by_branch = p.group_by in BRANCH_SUMMARY_LABELS
    rows = ledger_transactions(tables, p, ctx, detail=False)
    # Rows that are not shown still count towards the credit limit.
    rows = rows.withColumn("shown", disbursement_kept(p))
    if p.overdue_only:
        rows = rows.withColumn("shown", F.coalesce(F.col("shown") & is_overdue(p), F.lit(False)))
    rows = with_period_end_rate(rows, tables, p, ctx, always=False)
    rows = with_revaluation(rows, p, ctx)

    currency_keys = ["CurrencyCode", "CurrencyPK"] if p.in_invoice_currency else []
    branch_keys = ["BranchCode", "TranBranchName"] if by_branch else []
    keys = ["AccountPK", *branch_keys, *currency_keys, "PeriodEndRate"]
    sums = ageing_sums(p, ctx)
    once = ~F.coalesce("repeated_rate", F.lit(False))
    # Terms depend on department and branch too, so these stay apart until the terms are known.
    place = ["AH_GE", "AH_GB"] if p.is_ar else []
    df = rows.groupBy(*keys, *place).agg(
        *[F.sum(F.when(F.col("shown"), F.col(c))).alias(c) for c in sums],
        F.sum(F.when(once, F.col("Balance"))).alias("limit_balance"),
        F.max("shown").alias("shown"),
    )
    profile = account_profile(tables, p, ctx, ALL_PARTS)
    if p.is_ar:
        # A test that always holds, of all columns, so that the terms' keys come from the shuffle of the sums themselves.
        every = F.xxhash64(*df.columns).bitwiseOR(F.lit(1)) != 0
        profile = with_term_lists(profile, df.filter(every), tables, p)
    df = marked_rows(join_profile(df, profile, p), p).filter("shown")
    df = with_invoice_term(df) if p.is_ar else df.withColumn("InvoiceTerm", F.lit(""))
    df = df.groupBy(*AGEING_KEYS, *branch_keys, *currency_keys, "PeriodEndRate").agg(
        *[F.sum(c).alias(c) for c in sums], listed_terms().alias("InvoiceTerm")
    )
    absent = {"BranchCode", "TranBranchName", "CurrencyCode", "CurrencyPK"} - {*branch_keys, *currency_keys}
    df = df.withColumns(
        {
            **{c: F.lit(None).cast("string") for c in sorted(absent)},
            **null_amounts(c for c in AGEING_SUMS if c not in sums),
            "AverageExchangeRate": average_rate(ctx),
            # Of a narrower sum, so that the difference keeps the decimals of the revaluation.
            "GainLossOnRevaluation": F.col("RevaluedLocalEquivalent") - F.col("BalanceInLocal").cast("decimal(28,4)"),
        }
    )
    return df.select(*ageing_summary_columns())


def ageing_summary_columns() -> list[str]:
    """Output order of the ageing summary."""
    return [
        *AGEING_KEYS[:9],
        *AGEING_SUMS,
        "ConsolidationCategory",
        "ARCategory",
        "SettlementCode",
        "CountryCode",
        "CountryName",
        "OrgBranchName",
        "SalesRepName",
        "CreditControllerName",
        "CustomerServiceName",
        "SettlementName",
        "CurrencyCode",
        "CurrencyPK",
        "PeriodEndRate",
        "ContactPhoneNo",
        "InvoiceTerm",
        "AverageExchangeRate",
        "ARUseSettlementGroupCreditLimit",
        "SettlementGroupCreditLimit",
        "SettlementGroupOutstandingAmount",
        "BranchCode",
        "TranBranchName",
        "SettlementGroupOverCreditLimit",
        "AdditionalCompanyName",
        "GainLossOnRevaluation",
    ]


def ageing_summary_order(p: ReportParams) -> list[str]:
    """By sales rep, settlement group or account; further keys give ties an order."""
    first = p.order_by if p.order_by in ("SalesRepName", "SettlementCode") else "AccountCode"
    return list(dict.fromkeys([first, "AccountCode", "SettlementCode", "CurrencyCode", "BranchCode", "PeriodEndRate"]))
