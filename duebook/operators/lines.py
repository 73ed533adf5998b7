"""Line amounts per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import MONEY, money
from duebook.operators.headers import INVOICE_TYPES
from duebook.params import ReportParams
from duebook.sources.tables import Tables


def line_sums(tables: Tables) -> DataFrame:
    """Amount and tax of the lines of each transaction."""
    return (
        tables["AccTransactionLines"]
        .groupBy("AL_AH")
        .agg(
            money(F.sum("AL_LineAmount")).alias("LineInvoiceExTaxAmount"),
            money(F.sum("AL_GSTVAT")).alias("LineTaxAmount"),
        )
    )


def with_line_amounts(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Add line sums of invoices, credit and adjustment notes. Payables keep the sign of their lines."""
    if not p.line_amounts:
        nothing = F.lit(None).cast(MONEY)
        return df.withColumns({"LineInvoiceExTaxAmount": nothing, "LineTaxAmount": nothing})
    has_lines = F.col("TransactionType").isin(*INVOICE_TYPES)
    joined = df.join(line_sums(tables), (F.col("TransactionPK") == F.col("AL_AH")) & has_lines, "left")
    return joined.drop("AL_AH")
