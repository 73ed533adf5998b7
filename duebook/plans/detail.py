"""The detail report: one row per transaction, in one of six orders."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.ageing import BUCKETS, LOCAL_SUFFIX, with_buckets
from duebook.functions.columns import MONEY
from duebook.operators.accounts import ALL_PARTS, account_profile, has_account_filter
from duebook.operators.credit import over_limit_codes, settling_accounts
from duebook.operators.currency import with_period_end_rate, with_revaluation
from duebook.operators.dimensions import with_job_by_key, with_match_status_text, with_operator_initials
from duebook.operators.headers import is_overdue, overdue, reported_headers, type_description
from duebook.operators.lines import with_line_amounts
from duebook.operators.terms import resolve_terms
from duebook.operators.transactions import disbursement_kept, ledger_amounts, with_disbursement_charge
from duebook.params import (
    ORDER_BY_INVOICE_DATE,
    ORDER_BY_NUMBER,
    ORDER_BY_POST_DATE,
    ORDER_BY_TRANSACTION,
    ORDER_BY_TYPE,
    ReportParams,
)
from duebook.plans.context import RunContext
from duebook.sources.tables import Tables

#: Parts that the transactions of one of the busiest accounts are dealt to, how many accounts these are, and the columns
#: of a transaction's account and part, of whether the report asks for it, and of an account's terms.
ACCOUNT_PARTS = 32
BUSY_ACCOUNTS = 1000
KEY, PART, ASKED, TERMS = "account_key", "account_part", "asked", "account_terms"

# The columns of the detail report, in order, with their types.
DETAIL_COLUMNS = {
    "key": "TransactionPK AccountPK",
    "text1": "AccountCode AccountName BranchCode CountryCode CountryName TransactionType InvoiceRef Description "
    "InvoiceRef2 ContactInfo ContactName ContactPhoneNo",
    "key2": "OC_OH_AddressOverride",
    "money1": "InvoiceTotal Balance BalanceInLocal",
    "date1": "DueDate InvoiceDate",
    "key3": "CurrencyPK",
    "text2": "CurrencyCode CurrencyCode2",
    "money2": "NotDue1Total NotDue2Total NotDue3Total NotDue4Total Period1Total Period2Total Period3Total "
    "Period4Total PeriodCurrent NotDue1TotalInLocal NotDue2TotalInLocal NotDue3TotalInLocal NotDue4TotalInLocal "
    "Period1TotalInLocal Period2TotalInLocal Period3TotalInLocal Period4TotalInLocal PeriodCurrentInLocal",
    "text3": "SalesRep CreditController CustomerService",
    "money3": "CreditLimit",
    "text4": "AccountGroup OrgBranchCode IsOverLimit",
    "rate": "ExchangeRate",
    "text5": "IsDSBInvoice",
    "money4": "DSBCharge OSTotal",
    "text6": "ARCategory ConsolidationCategory SettlementCode AccountCode2 OrgBranchName TranBranchName "
    "SalesRepName CreditControllerName CustomerServiceName SettlementName",
    "int": "RXSubUnitRatio",
    "date2": "PostDate",
    "text7": "DepartmentCode",
    "date3": "FullyPaidDate",
    "text8": "InvoiceTerm",
    "money5": "InvoiceExTax TaxAmount",
    "text9": "JobNumber TransactionTypeDesc OperatorInitials",
    "money6": "LineInvoiceExTaxAmount LineTaxAmount",
    "text10": "ARUseSettlementGroupCreditLimit",
    "money7": "SettlementGroupCreditLimit SettlementGroupOutstandingAmount",
    "text11": "SettlementGroupOverCreditLimit UsingOrgAsOwnSettlementGroup AgreedPaymentMethod AdditionalCompanyName",
    "money8": "MatchedInFuturePeriodInLocalCurrency MatchedInFuturePeriodInInvoiceCurrency",
    "text12": "MatchStatus MatchStatusReason",
}
#: Columns that the others of a row tell. They are added last, so that no shuffle carries them.
TOLD_BY_OTHERS = {*BUCKETS, *(name + LOCAL_SUFFIX for name in BUCKETS), "DSBCharge", "TransactionTypeDesc", "AccountCode2", "CurrencyCode2"}
_TYPES = {"text": "string", "money": MONEY, "date": "timestamp_ntz", "rate": "decimal(18,9)", "int": "int"}


def detail_columns(df: DataFrame) -> list[Column]:
    """All report columns with their types; those the path does not fill are null."""
    columns = []
    for kind, names in DETAIL_COLUMNS.items():
        wanted = _TYPES.get(kind.rstrip("0123456789"))
        for name in names.split():
            value = F.col(name) if name in df.columns else F.lit(None)
            columns.append((value.cast(wanted) if wanted else value).alias(name))
    return columns


def account_key(account: Column) -> Column:
    """An account's key as text that is never null: a test for null would be carried down to the transactions."""
    return F.coalesce(F.concat(F.lit("="), account.cast("string")), F.lit(""))


def marked_over_limit(profile: DataFrame, slim: DataFrame, sums: DataFrame) -> DataFrame:
    """Mark accounts over their limit, from sums of dealt transactions."""
    owed = sums.groupBy(F.col(KEY).alias("owing")).agg(F.sum("Balance").alias("Balance"))
    balances = slim.select("AccountPK", "AccountCode", "CreditLimit").join(owed, account_key(F.col("AccountPK")) == F.col("owing"))
    codes = over_limit_codes(balances)
    marked = profile.join(codes, F.col("AccountCode") == F.col("over_code"), "left")
    return marked.withColumn("IsOverLimit", F.when(F.col("over_code").isNotNull(), "*")).drop("over_code")


def needs_account(p: ReportParams) -> bool:
    """The listing needs an account; ageing does only if a filter looks at it."""
    return p.all_transactions or has_account_filter(p)


def join_profile(df: DataFrame, profile: DataFrame, p: ReportParams, dealt_to: DataFrame | None = None) -> DataFrame:
    """Join accounts. What the report says of transactions without an account is filled in here.

    Transactions that have been dealt meet the profile part by part: it is repeated for the parts that its account is
    dealt to. Where only some transactions are asked for, the
    parts tell so and the join drops the others: a filter would be carried down to one of the two readers of the shuffle.
    """
    how = "inner" if needs_account(p) else "left"
    renamed = profile.withColumnRenamed("AccountPK", "profile_pk")
    if dealt_to is not None:
        part = [F.col(KEY).alias("profile_key"), F.col(PART).alias("profile_part")]
        same = account_key(F.col("profile_pk")) == F.col("profile_key")
        on = (F.col(KEY) == F.col("profile_key")) & (F.col(PART) == F.col("profile_part"))
        if ASKED in df.columns:
            asked = dealt_to.groupBy(*part).agg(F.max(ASKED).alias("profile_asked"))
            # True is not less than true. An equality would be one more key, and the transactions shuffled anew by it.
            renamed, on = asked.join(renamed, same, how), on & (F.col(ASKED) >= F.col("profile_asked"))
        else:
            renamed = renamed.join(dealt_to.select(*part).distinct(), same)
    elif TERMS in profile.columns:
        # Terms of transactions without an account stand under the key null.
        on = F.col("AccountPK").eqNullSafe(F.col("profile_pk"))
    else:
        on = F.col("AccountPK") == F.col("profile_pk")
    joined = df.join(renamed, on, "inner" if ASKED in df.columns else how)
    joined = joined.drop("profile_key", "profile_part", "profile_asked", ASKED)
    if how == "left":
        if "SettlementGroupOverCreditLimit" in profile.columns:
            over = F.coalesce("SettlementGroupOverCreditLimit", F.lit("N"))
            joined = joined.withColumn("SettlementGroupOverCreditLimit", over)
            if not p.is_ar:
                joined = joined.withColumn("UsingOrgAsOwnSettlementGroup", F.lit("N"))
        if p.is_ar:
            joined = joined.withColumn("AccountTerm", F.coalesce("AccountTerm", F.lit("")))
    return joined.drop("profile_pk")


def fan_out_lines(df: DataFrame, profile: DataFrame, p: ReportParams) -> DataFrame:
    """Optionally multiply line sums of accounts that several others settle for, once per repetition."""
    if not (p.literal_fanout and p.line_amounts):
        return df
    times = profile.groupBy(F.col("AccountPK").alias("repeated")).agg(F.count(F.lit(1)).alias("times"))
    joined = df.join(times, F.col("AccountPK") == F.col("repeated"), "left")
    factor = F.coalesce("times", F.lit(1))
    sums = ("LineInvoiceExTaxAmount", "LineTaxAmount")
    return joined.withColumns({c: (F.col(c) * factor).cast(MONEY) for c in sums}).drop("repeated", "times")


TERM_KEYS = ("AccountPK", "SettlementPK", "AH_GE", "AH_GB")


def account_terms(found: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Terms by account, settling account, department and branch, for the (AccountPK, AH_GE, AH_GB) found."""
    found = found.select("AccountPK", "AH_GE", "AH_GB").distinct()
    found = found.join(settling_accounts(tables, p), F.col("AccountPK") == F.col("PR_OH_Parent"), "left")
    return resolve_terms(found.select(*TERM_KEYS), tables, p)


def with_term_lists(profile: DataFrame, found: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The profile with the terms of each account's departments and branches, so that transactions get theirs with it.

    An account has as many as the company has pairs of department and branch, at most. Where transactions without an
    account are reported, those have their terms under their key, or null.
    """
    terms = account_terms(found, tables, p)
    lists = terms.groupBy("AccountPK", "SettlementPK").agg(F.collect_list(F.struct("AH_GE", "AH_GB", "InvoiceTerm")).alias(TERMS))
    lists = lists.select(F.col("AccountPK").alias("term_account"), F.col("SettlementPK").alias("term_settlement"), TERMS)
    same = F.col("AccountPK").eqNullSafe(F.col("term_account")) & F.col("SettlementPK").eqNullSafe(F.col("term_settlement"))
    joined = profile.join(lists, same, "left" if needs_account(p) else "full")
    account = F.coalesce("AccountPK", "term_account").alias("AccountPK")
    return joined.select(account, *[c for c in profile.columns if c != "AccountPK"], TERMS)


def with_invoice_term(df: DataFrame) -> DataFrame:
    """The term of the row's department and branch, where the account's own term leaves it open."""
    fits = F.filter(TERMS, lambda t: t["AH_GE"].eqNullSafe(F.col("AH_GE")) & t["AH_GB"].eqNullSafe(F.col("AH_GB")))
    term = F.when(F.col("AccountTerm") == "", F.coalesce(F.get(fits, F.lit(0))["InvoiceTerm"], "AccountTerm")).otherwise(F.col("AccountTerm"))
    return df.drop("InvoiceTerm").withColumn("InvoiceTerm", term).drop(TERMS)


def busy_accounts(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """The accounts with the most transactions. Any other has less than one in BUSY_ACCOUNTS of all."""
    found = reported_headers(tables, p, ctx).filter(F.col("AH_OH").isNotNull()).groupBy("AH_OH").agg(F.count(F.lit(1)).alias("found"))
    return found.orderBy(F.desc("found"), "AH_OH").limit(BUSY_ACCOUNTS).select(F.col("AH_OH").alias("busy_account"))


def dealt(rows: DataFrame, p: ReportParams, busy: DataFrame | None = None) -> DataFrame:
    """What the report reads of the transactions, shuffled by account and a part of it: a hot account is many tasks.

    Accounts other than the busy ones, if these are given, are one part each, so that their profiles are not repeated.
    """
    wanted = {name for names in DETAIL_COLUMNS.values() for name in names.split()}
    wanted = wanted - TOLD_BY_OTHERS | {ASKED} | ({"AH_GE", "AH_GB"} if has_terms(p) else set())
    part = F.coalesce(F.pmod(F.xxhash64("TransactionPK"), F.lit(ACCOUNT_PARTS)).cast("int"), F.lit(0))
    rows = with_operator_initials(rows, p)
    if needs_account(p):
        rows = rows.filter(F.col("AccountPK").isNotNull())
    if busy is not None:
        rows = rows.join(F.broadcast(busy), F.col("AccountPK") == F.col("busy_account"), "left")
        part = F.when(F.col("AccountPK").isNull() | F.col("busy_account").isNotNull(), part).otherwise(0)
    rows = rows.select(*[c for c in rows.columns if c in wanted], account_key(F.col("AccountPK")).alias(KEY), part.alias(PART))
    return rows.repartition(KEY, PART)


def part_sums(rows: DataFrame) -> DataFrame:
    """Sums of the balances of dealt transactions where these lie, before parts are put together.

    Their checksum makes the sums take every column that the report takes, so that both read one and the same shuffle.
    """
    keys = [c for c in (KEY, PART, "AccountPK", "AH_GE", "AH_GB") if c in rows.columns]
    sums = [F.sum("Balance").alias("Balance"), F.max(F.xxhash64(*rows.columns)).alias("checksum")]
    if ASKED in rows.columns:
        # True, or null where no transaction is asked for.
        sums.append(F.max(F.when(F.col(ASKED), True)).alias(ASKED))
    sums = rows.groupBy(*keys).agg(*sums)
    return sums.filter(F.col("checksum").isNotNull()).drop("checksum")


def has_terms(p: ReportParams) -> bool:
    """Whether terms depend on the account: receivables ageing. The listing words the header's own."""
    return p.is_ar and not p.all_transactions


def asked_for(p: ReportParams, in_question_only: bool) -> Column | None:
    """Condition of the transactions that the report shows, of those that count for the over-limit mark; None: all."""
    tests = [disbursement_kept(p)] if p.is_ar and p.disbursement_only else []
    if in_question_only and p.overdue_only and p.order_by != ORDER_BY_TRANSACTION:
        tests.append(F.coalesce(is_overdue(p), F.lit(False)))
    return functools.reduce(Column.__and__, tests) if tests else None


def detail_transactions(tables: Tables, p: ReportParams, ctx: RunContext, in_question_only: bool) -> DataFrame:
    """Transactions with their amounts, lines and jobs; what these tell comes last (`completed`)."""
    df = with_line_amounts(ledger_amounts(tables, p, ctx, jobs=False), tables, p)
    asked = asked_for(p, in_question_only)
    if asked is not None:
        df = with_disbursement_charge(df, p).withColumn(ASKED, asked).drop("DSBCharge")
    return with_job_by_key(df, reported_headers(tables, p, ctx), tables, p)


def narrow_set(
    tables: Tables, p: ReportParams, ctx: RunContext, parts: frozenset[str] = ALL_PARTS, in_question_only: bool = False
) -> DataFrame:
    """All reported transactions with the columns that `completed` does not add, not yet ordered."""
    profile = account_profile(tables, p, ctx, parts)
    transactions = fan_out_lines(detail_transactions(tables, p, ctx, in_question_only), profile, p)
    rows = dealt(transactions, p, busy_accounts(tables, p, ctx))
    sums = part_sums(rows)
    if p.over_limit_only is False:
        profile = marked_over_limit(profile, account_profile(tables, p, ctx, frozenset()), sums)
    if has_terms(p):
        profile = with_term_lists(profile, sums, tables, p)
    df = join_profile(rows, profile, p, sums)
    if has_terms(p):
        df = with_invoice_term(df)
    df = with_match_status_text(df, tables, p)
    given = [c for names in DETAIL_COLUMNS.values() for c in names.split() if c in df.columns]
    return df.select(*given)


def completed(df: DataFrame, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Rows of `narrow_set`, ordered or not, with all columns of the report; those that came since stand behind."""
    came = [c for c in df.columns if not any(c in names.split() for names in DETAIL_COLUMNS.values())]
    df = with_buckets(with_disbursement_charge(df, p), p, ctx.dates)
    if p.all_transactions:
        df = df.withColumn("TransactionTypeDesc", type_description(F.col("TransactionType")))
    df = df.withColumns({"AccountCode2": F.col("AccountCode"), "CurrencyCode2": F.col("CurrencyCode")})
    return df.select(*detail_columns(df), *came)


def working_set(
    tables: Tables, p: ReportParams, ctx: RunContext, parts: frozenset[str] = ALL_PARTS
) -> DataFrame:
    """All reported transactions with all their columns, not yet ordered."""
    return completed(narrow_set(tables, p, ctx, parts), p, ctx)


def detail_order(p: ReportParams) -> list[Column]:
    """Sort keys of the detail report. The transaction key comes last, so that ties have an order too."""
    kind, number, posted = F.col("TransactionType"), F.col("InvoiceRef"), F.to_date("PostDate")
    account, last = F.col("AccountCode"), F.col("TransactionPK")
    invoiced = F.to_date("DueDate" if p.legacy_invoice_sort else "InvoiceDate")
    orders = {
        ORDER_BY_TRANSACTION: [account, number],
        ORDER_BY_POST_DATE: [posted, kind, number],
        ORDER_BY_INVOICE_DATE: [invoiced, kind, number],
        ORDER_BY_TYPE: [kind, number, posted],
        ORDER_BY_NUMBER: [number, kind, posted],
    }
    return [*orders.get(p.order_by, [account, F.col("InvoiceDate")]), last]


def is_revalued(p: ReportParams) -> bool:
    return p.order_by not in (
        ORDER_BY_TRANSACTION,
        ORDER_BY_POST_DATE,
        ORDER_BY_INVOICE_DATE,
        ORDER_BY_TYPE,
        ORDER_BY_NUMBER,
    )


def in_question(df: DataFrame, p: ReportParams) -> DataFrame:
    """Only overdue rows, if asked. The plain transaction order lists all, due or not."""
    return df if p.order_by == ORDER_BY_TRANSACTION else overdue(df, p)


def ordered(df: DataFrame, p: ReportParams) -> DataFrame:
    return in_question(df, p).orderBy(*detail_order(p))


def detail_rows(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """The rows of the detail report, in no order, with the columns that `finished` does not add."""
    df = narrow_set(tables, p, ctx, in_question_only=True)
    if is_revalued(p):
        df = with_period_end_rate(df, tables, p, ctx, always=True).drop("repeated_rate")
    return df


def finished(df: DataFrame, p: ReportParams, ctx: RunContext) -> DataFrame:
    """The rows of `detail_rows`, in the order that they have, with all columns."""
    df = completed(df, p, ctx)
    return with_revaluation(df, p, ctx) if is_revalued(p) else df
