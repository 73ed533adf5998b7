"""Signs, invoice currency and period-end rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.columns import in_list, moment, money, round_by_subunit
from duebook.params import ReportParams
from duebook.plans.context import RunContext
from duebook.sources.tables import Tables

# Amounts whose sign payables turn.
SIGNED_AMOUNTS = (
    "Balance",
    "BalanceInLocal",
    "InvoiceTotal",
    "OSTotal",
    "InvoiceExTax",
    "TaxAmount",
    "MatchedInFuturePeriodInLocalCurrency",
    "MatchedInFuturePeriodInInvoiceCurrency",
)
#: Parts that the rows of one currency are dealt to when rates are joined and cannot be broadcast.
CURRENCY_SPREAD = 64


def flip_payable_signs(df: DataFrame, p: ReportParams) -> DataFrame:
    if p.is_ar:
        return df
    return df.withColumns({c: -F.col(c) for c in SIGNED_AMOUNTS if c in df.columns})


def restate_in_invoice_currency(df: DataFrame, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Turn the balance and the later-matched amount into invoice currency.

    A balance that equals the total is left for the last step, which takes the
    invoice-currency total instead. That step sees the balance as just converted.
    """
    if not p.in_invoice_currency:
        return df
    rate, ratio = F.col("ExchangeRate"), F.col("RXSubUnitRatio")
    foreign = rate != 1
    usable = foreign & (rate != 0)

    def converted(amount: str) -> Column:
        value = F.col(amount) / rate if ctx.reciprocal_rates else F.col(amount) * rate
        return round_by_subunit(value, ratio)

    # Only division guards the balance against a rate of zero.
    guard = (usable if ctx.reciprocal_rates else foreign) & (F.col("InvoiceTotal") != F.col("Balance"))
    later = "MatchedInFuturePeriodInInvoiceCurrency"
    df = df.withColumns(
        {
            "Balance": F.when(guard, converted("Balance")).otherwise(F.col("Balance")),
            later: F.when(usable, converted(later)).otherwise(F.col(later)),
        }
    )
    whole = foreign & (F.col("InvoiceTotal") == F.col("Balance"))
    return df.withColumn("Balance", F.when(whole, F.col("OSTotal")).otherwise(F.col("Balance")))


def period_end_rates(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Rates valid on the last day of the current period, of the types the company adjusts by.

    Several such types give several rows.
    """
    rates = tables["RefExchangeRate"].filter(F.col("RE_GC") == F.lit(p.company))
    end = ctx.dates.current_end
    if end is None:
        return rates.filter(F.lit(False))
    day = moment(end.replace(hour=0, minute=0, second=0, microsecond=0))
    rates = rates.filter((F.col("RE_StartDate") <= day) & (F.col("RE_ExpiryDate") >= day))
    if p.exchange_rate_types is not None:
        return rates.filter(in_list(F.col("RE_ExRateType"), p.exchange_rate_types))
    types = tables["ExchangeRateTypes"].filter(F.col("ET_GC") == F.lit(p.company)).select("ExchangeRateType")
    return rates.join(types, F.col("RE_ExRateType") == F.col("ExchangeRateType"), "left_semi")


def with_period_end_rate(
    df: DataFrame, tables: Tables, p: ReportParams, ctx: RunContext, always: bool, spread_by: str = "TransactionPK"
) -> DataFrame:
    """Join the rates of the period's last day; use them always, or only when balances are in invoice currency.

    The join is made either way: several valid rates repeat a row whether or not they are used.
    Repetitions are marked, for sums that must count a row once.
    """
    # One currency has a handful of rates on a day, one per rate type.
    types = Window.partitionBy("RE_RX_NKExCurrency").orderBy("RE_ExRateType", "RE_SellRate")
    rates = period_end_rates(tables, p, ctx).withColumn("repeated_rate", F.row_number().over(types) > 1)
    currency = {"RX_PK": "CurrencyPK", "RX_Code": "CurrencyCode", "RX_SubUnitRatio": "RXSubUnitRatio"}
    df = df.withColumns({new: F.col(old) for new, old in currency.items()})
    # A shuffle by currency alone would send most rows to a few tasks; rates are few, so they are repeated instead.
    spread = F.pmod(F.xxhash64(spread_by), F.lit(CURRENCY_SPREAD))
    repeated = rates.withColumn("rate_spread", F.explode(F.sequence(F.lit(0), F.lit(CURRENCY_SPREAD - 1))))
    on = (F.col("RE_RX_NKExCurrency") == F.col("RX_Code")) & (F.col("row_spread") == F.col("rate_spread"))
    df = df.withColumn("row_spread", spread.cast("int")).join(repeated, on, "left").drop("row_spread", "rate_spread")
    used = always or p.in_invoice_currency
    return df.withColumn("PeriodEndRate", F.col("RE_SellRate") if used else F.lit(None).cast("decimal(18,9)"))


def with_revaluation(df: DataFrame, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Local value at the period-end rate, and the gain or loss against the booked local balance."""
    rate, balance, local = F.col("PeriodEndRate"), F.col("Balance"), F.col("BalanceInLocal")
    revalued = balance * rate if ctx.reciprocal_rates else balance / rate
    df = df.withColumn("RevaluedLocalEquivalent", F.when(rate.isNull(), local).otherwise(revalued))
    change = F.col("RevaluedLocalEquivalent") - local
    gain, loss = (change >= 0, change < 0) if p.is_ar else (change <= 0, change > 0)
    return df.withColumns(
        {
            "GainLossOnRevaluation": change,
            "GainOnRevaluation": F.when(gain, F.abs(change)),
            "LossOnRevaluation": F.when(loss, F.abs(change)),
        }
    )
