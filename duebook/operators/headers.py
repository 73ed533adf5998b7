"""Transaction headers: which are reported and what is taken from each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import clock, in_list, moment, three_places
from duebook.params import ReportParams
from duebook.plans.context import DateRange, RunContext
from duebook.sources.tables import Tables

# Transaction types and their descriptions.
TYPE_DESCRIPTIONS = {
    "INV": "Invoice",
    "CRD": "Credit Notes",
    "ADJ": "Adjustment Notes",
    "JNL": "Journals",
    "CTR": "Contras",
    "TRF": "Transfers",
    "REC": "Receipts",
    "PAY": "Payments",
    "EXX": "Exchanges",
    "DSC": "Discounts",
    "OVP": "Overpayments",
}
INVOICE_TYPES = ("INV", "ADJ", "CRD")
NOT_BALANCED_TYPE = "INB"
# Transaction categories that mark a disbursement, and the mark.
DISBURSEMENT_CATEGORIES = ("DBT", "DCU", "DCD", "DBD")
PAYABLE_DISBURSEMENT_CATEGORIES = ("DBT",)
DISBURSEMENT_MARK = "DSB"
NO_PAYMENT_METHOD = "Undefined"


def of_ledger(headers: DataFrame, p: ReportParams) -> DataFrame:
    """Headers of the company's ledger. Both tests reach the scan."""
    return headers.filter((F.col("AH_Ledger") == p.ledger) & (F.col("AH_GC") == F.lit(p.company)))


def in_range(column: str, dates: DateRange) -> list[Column]:
    tests = []
    if dates.start is not None:
        tests.append(F.col(column) >= moment(dates.start))
    if dates.end is not None:
        tests.append(F.col(column) < moment(dates.end))
    return tests


def payment_method() -> Column:
    method = F.col("AH_AgreedPaymentMethodOverride")
    return F.when(method != "", method).otherwise(NO_PAYMENT_METHOD)


def listing_headers(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Headers of the all-transactions listing: by dates and type. No types, no rows."""
    df = of_ledger(tables["AccTransactionHeader"], p)
    for test in (
        in_range("AH_PostDate", ctx.post) + in_range("AH_DueDate", ctx.due) + in_range("AH_InvoiceDate", ctx.invoice)
    ):
        df = df.filter(test)
    return df.filter(in_list(F.col("AH_TransactionType"), p.transaction_types))


def open_headers(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Headers posted and not yet fully paid as of the report date."""
    as_of = moment(ctx.dates.report_date)
    paid = F.col("AH_FullyPaidDate")
    return of_ledger(tables["AccTransactionHeader"], p).filter(
        (F.col("AH_TransactionType") != NOT_BALANCED_TYPE)
        & ((paid > as_of) | paid.isNull())
        & (F.col("AH_PostDate") <= as_of)
    )


def reported_headers(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """The headers of the chosen path, with the filters on header columns applied."""
    df = listing_headers(tables, p, ctx) if p.all_transactions else open_headers(tables, p, ctx)
    if p.posted_to_gl != "":
        # An absent flag, unlike a blank one, equals nothing.
        df = df.filter(F.lit(False) if p.posted_to_gl is None else F.col("AH_PostToGL") == p.posted_to_gl)
    if p.payment_methods is not None:
        df = df.filter(in_list(payment_method(), p.payment_methods))
    return df


def type_description(kind: Column) -> Column:
    described = None
    for code, text in TYPE_DESCRIPTIONS.items():
        described = F.when(kind == code, text) if described is None else described.when(kind == code, text)
    return described


def disbursement_mark(p: ReportParams) -> Column:
    """Receivables know four disbursement categories, the payables listing one, payables ageing none."""
    if not p.is_ar and not p.all_transactions:
        return F.lit("")
    categories = DISBURSEMENT_CATEGORIES if p.is_ar else PAYABLE_DISBURSEMENT_CATEGORIES
    return F.when(F.col("AH_TransactionCategory").isin(*categories), DISBURSEMENT_MARK).otherwise("")


def header_term() -> Column:
    """Invoice term as the listing words it: term, days on three places, unit."""
    term = F.col("AH_InvoiceTerm")
    days = F.rpad(three_places(F.col("AH_InvoiceTermDays")), 3, " ")
    worded = (
        F.when(term.isin("COD", "PIA"), term)
        .when(term == "MIC", F.concat(term, F.lit(" "), days, F.lit(" Months")))
        .otherwise(F.concat(term, F.lit(" "), days, F.lit(" Days")))
    )
    return F.when(F.col("AH_TransactionType").isin(*INVOICE_TYPES), worded).otherwise("")


def header_columns(p: ReportParams) -> dict[str, Column]:
    """Report columns that come straight from the header, other than amounts owed."""
    columns = {
        "TransactionPK": F.col("AH_PK"),
        "AccountPK": F.col("AH_OH"),
        "TransactionType": F.col("AH_TransactionType"),
        "InvoiceRef": F.col("AH_TransactionNum"),
        "Description": F.col("AH_Desc"),
        "InvoiceRef2": F.col("AH_ConsolidatedInvoiceRef"),
        "InvoiceTotal": F.col("AH_LocalTotal"),
        "OSTotal": F.col("AH_OSTotal"),
        "DueDate": F.col("AH_DueDate"),
        "InvoiceDate": F.col("AH_InvoiceDate"),
        "PostDate": F.col("AH_PostDate"),
        "ExchangeRate": F.col("AH_ExchangeRate"),
        "IsDSBInvoice": disbursement_mark(p),
        "OperatorInitials": F.col("AH_SystemCreateUser"),
        "AgreedPaymentMethod": F.col("AH_AgreedPaymentMethodOverride"),
        "MatchStatus": F.col("AH_MatchStatus"),
        "MatchStatusReason": F.col("AH_MatchStatusReasonCode"),
    }
    if p.all_transactions:
        columns |= {
            "TransactionTypeDesc": type_description(F.col("AH_TransactionType")),
            "FullyPaidDate": F.col("AH_FullyPaidDate"),
            "InvoiceTerm": header_term(),
            "InvoiceExTax": F.col("AH_InvoiceAmount"),
            "TaxAmount": F.col("AH_GSTAmount"),
        }
    return columns


def is_overdue(p: ReportParams) -> Column:
    """Due by now. Unknown without a due date."""
    return F.col("DueDate") <= clock(p.now)


def overdue(df: DataFrame, p: ReportParams) -> DataFrame:
    return df.filter(is_overdue(p)) if p.overdue_only else df
