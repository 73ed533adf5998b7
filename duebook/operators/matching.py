"""Amounts matched against a transaction, and balances as of a date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import delete_where, moment, money, zero
from duebook.params import ReportParams
from duebook.plans.context import RunContext
from duebook.sources.snapshots import with_matched
from duebook.sources.tables import Tables

# Transaction types that settle others.
SETTLING_TYPES = ("PAY", "REC")


def matched_amount(links: DataFrame, condition: Column) -> DataFrame:
    """Sum of the matches of each transaction that meet a date condition."""
    return links.filter(condition).groupBy("AP_AH").agg(money(F.sum("AP_Amount")).alias("matched"))


def future_match_groups(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Match groups with a receipt or payment posted after the report date."""
    headers = tables["AccTransactionHeader"].filter(
        F.col("AH_TransactionType").isin(*SETTLING_TYPES)
        & (F.col("AH_PostDate") > moment(ctx.dates.report_date))
    )
    if not p.future_match_all_companies:
        headers = headers.filter(F.col("AH_GC") == F.lit(p.company))
    return (
        tables["AccTransactionMatchLink"]
        .join(headers.select("AH_PK"), F.col("AP_AH") == F.col("AH_PK"), "left_semi")
        .select(F.col("AP_MatchGroupNum").alias("future_group"))
        .distinct()
    )


#: Parts that the links of one match group are dealt to.
GROUP_PARTS = 32


def future_matches(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Per transaction, what was matched in those groups.

    The links are cut down to the groups before anything is summed, as those groups are few. A group may hold a large
    part of all links, so links meet their group part by part, by their transaction, and are summed in part.
    The groups are never broadcast: Spark takes their size without the parts, and the driver would hold all of these.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1))).alias("group_part")
    groups = future_match_groups(tables, p, ctx).select("future_group", parts).hint("merge")
    links = tables["AccTransactionMatchLink"].withColumn("link_part", F.pmod(F.xxhash64("AP_AH"), F.lit(GROUP_PARTS)).cast("int"))
    same = (F.col("AP_MatchGroupNum") == F.col("future_group")) & (F.col("link_part") == F.col("group_part"))
    return links.join(groups, same, "left_semi").groupBy("AP_AH").agg(money(F.sum("AP_Amount")).alias("future_matched"))


def with_matches(headers: DataFrame, tables: Tables, at: datetime, after: bool) -> DataFrame:
    """Add what was matched up to a moment, or after it: from snapshots and the links since, or from all links."""
    if tables.snapshots is not None:
        return with_matched(headers, tables.snapshots.terms_after(at) if after else tables.snapshots.terms_upto(at))
    when = F.col("AP_MatchDate")
    links = matched_amount(tables["AccTransactionMatchLink"], when > moment(at) if after else when <= moment(at))
    return headers.join(links, F.col("AH_PK") == F.col("AP_AH"), "left").drop("AP_AH")


def with_balance(headers: DataFrame, tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Add the balance. Current balances need no match links at all.

    The listing starts from the total and takes off matches up to the cut-off; ageing
    starts from what is open now and puts back matches made after the report date.
    """
    outstanding = F.col("AH_OutstandingAmount")
    listing = p.all_transactions
    if ctx.use_outstanding:
        df, balance = headers, outstanding
    elif listing and ctx.match_cutoff is None:
        df, balance = headers, F.col("AH_LocalTotal")
    else:
        df = with_matches(headers, tables, ctx.match_cutoff if listing else ctx.dates.report_date, after=not listing)
        matched = F.coalesce(F.col("matched"), zero())
        balance = F.col("AH_LocalTotal") - matched if listing else outstanding + matched
    df = df.withColumns(
        {
            "Balance": money(balance),
            # The listing carries no local balance of its own.
            "BalanceInLocal": zero() if listing else money(balance),
        }
    ).drop("matched")
    if not listing and not p.future_matches_apart:
        df = df.filter(F.col("Balance") != 0)
    return df


# Rows each payment status removes; rows with unknown amounts stay.
def settled_differently(status: str) -> Column | None:
    total, balance = F.col("InvoiceTotal"), F.col("Balance")
    return {
        "FUL": balance != 0,
        "UNP": (total != balance) | ((total == 0) & (balance == 0)),
        "PAR": (total == balance) | (balance == 0),
    }.get(status)


def of_payment_status(df: DataFrame, p: ReportParams) -> DataFrame:
    """Fully paid, unpaid or partly paid transactions. The listing only."""
    condition = settled_differently(p.payment_status) if p.all_transactions else None
    return df if condition is None else delete_where(df, condition)


def with_future_matches(df: DataFrame, tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Show what later receipts and payments matched, and move it in or out of the balance."""
    if not p.future_matches_apart:
        nothing = F.lit(None).cast("decimal(19,4)")
        return df.withColumns(
            {"MatchedInFuturePeriodInLocalCurrency": nothing, "MatchedInFuturePeriodInInvoiceCurrency": nothing}
        )
    amounts = future_matches(tables, p, ctx)
    df = df.join(amounts, F.col("TransactionPK") == F.col("AP_AH"), "left").drop("AP_AH")
    matched = F.coalesce(F.col("future_matched"), zero())
    sign = 0
    if p.exclude_future_matches and not ctx.use_outstanding:
        sign = -1
    elif not p.exclude_future_matches and ctx.use_outstanding:
        sign = 1
    columns = {
        "MatchedInFuturePeriodInLocalCurrency": matched,
        "MatchedInFuturePeriodInInvoiceCurrency": matched,
    }
    if sign:
        columns |= {c: money(F.col(c) + sign * matched) for c in ("Balance", "BalanceInLocal")}
    df = df.withColumns(columns).drop("future_matched")
    return df if p.summary_only else drop_zero_balance(df)


def drop_zero_balance(df: DataFrame) -> DataFrame:
    return delete_where(df, F.col("Balance") == 0)
