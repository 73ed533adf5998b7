"""Transactions with all that can be said of them without looking at their accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.ageing import with_buckets
from duebook.functions.columns import MONEY
from duebook.operators.collections import without_active_collections
from duebook.operators.currency import flip_payable_signs, restate_in_invoice_currency
from duebook.operators.dimensions import with_branch, with_currency, with_department, with_job
from duebook.operators.headers import DISBURSEMENT_MARK, header_columns, reported_headers
from duebook.operators.lines import with_line_amounts
from duebook.operators.matching import of_payment_status, with_balance, with_future_matches
from duebook.params import ReportParams
from duebook.plans.context import RunContext
from duebook.sources.tables import Tables


def base_transactions(tables: Tables, p: ReportParams, ctx: RunContext, jobs: bool = True) -> DataFrame:
    """Reported headers with balance, branch, department, currency and, if asked for, job.

    Joins on the transaction's key come first and next to each other, so that one
    shuffle of the headers serves them all. The job, whose key is another, comes last.
    """
    df = reported_headers(tables, p, ctx)
    df = without_active_collections(df, tables, p)
    df = with_balance(df, tables, p, ctx)
    df = with_branch(df, tables, p)
    df = with_department(df, tables, p)
    df = with_currency(df, tables, p)
    kept = ["AH_GE", "AH_GB", "Balance", "BalanceInLocal", "BranchCode", "TranBranchName", "DepartmentCode"]
    kept += ["CurrencyPK", "CurrencyCode", "RXSubUnitRatio", "AH_JH"]
    df = of_payment_status(df.select(*[v.alias(k) for k, v in header_columns(p).items()], *kept), p)
    return with_job(df, tables, p) if jobs else df


def with_disbursement_charge(df: DataFrame, p: ReportParams) -> DataFrame:
    """The balance of disbursement invoices. Receivables only."""
    charge = F.when(F.col("IsDSBInvoice") == DISBURSEMENT_MARK, F.col("Balance")) if p.is_ar else F.lit(None)
    return df.withColumn("DSBCharge", charge.cast(MONEY))


def disbursement_kept(p: ReportParams):
    """Condition of the rows left when only disbursements are asked for."""
    if p.is_ar and p.disbursement_only:
        return F.coalesce(F.col("DSBCharge") != 0, F.lit(False))
    return F.lit(True)


def ledger_amounts(tables: Tables, p: ReportParams, ctx: RunContext, jobs: bool = True) -> DataFrame:
    """Transactions with their final balances. The order of the steps matters: each reads what the last left."""
    df = base_transactions(tables, p, ctx, jobs=jobs)
    df = with_future_matches(df, tables, p, ctx)
    df = flip_payable_signs(df, p)
    return restate_in_invoice_currency(df, p, ctx)


def ledger_transactions(tables: Tables, p: ReportParams, ctx: RunContext, detail: bool = True) -> DataFrame:
    """Transactions with all amounts, before the rows other than disbursements are dropped."""
    df = ledger_amounts(tables, p, ctx, jobs=False)
    df = with_disbursement_charge(df, p)
    df = with_buckets(df, p, ctx.dates)
    df = with_line_amounts(df, tables, p)
    return with_job(df, tables, p) if detail else df
