"""Invoice terms of receivables accounts, by how closely a term record fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import first_row, three_places
from duebook.params import ReportParams
from duebook.sources.tables import Tables, of_company

def term_records(tables: Tables, p: ReportParams) -> DataFrame:
    """Term records, at most one per account, department and branch; null stands for all of them."""
    values = [F.col("PY_InvoiceTerm"), F.col("PY_InvoiceDays")]
    return (
        of_company(tables["ArTerms"], "PY_GC", p.company)
        .groupBy("PY_OH", "PY_GE", "PY_GB")
        .agg(first_row(values, values)["row"].alias("record"))
    )


def best_terms(keys: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The closest fitting record for each (org, AH_GE, AH_GB).

    A key fits records of its department and branch, of its department, of its branch
    and of neither, closest first. Each key is spelled out in these four ways and joined
    by equality, so an org with many records is never paired with all its keys.
    """
    department, branch, every = F.col("AH_GE"), F.col("AH_GB"), F.lit(None)
    ways = F.array(
        *[
            F.struct(F.lit(n).alias("fit"), ge.cast("string").alias("fit_ge"), gb.cast("string").alias("fit_gb"))
            for n, (ge, gb) in enumerate([(department, branch), (department, every), (every, branch), (every, every)])
        ]
    )
    spelled = keys.select("org", "AH_GE", "AH_GB", F.inline(ways)).filter(
        # A key without department or branch fits only the records for all of them.
        ~(F.col("fit").isin(0, 1) & department.isNull()) & ~(F.col("fit").isin(0, 2) & branch.isNull())
    )
    found = spelled.join(
        term_records(tables, p),
        (F.col("org") == F.col("PY_OH"))
        & F.col("fit_ge").eqNullSafe(F.col("PY_GE").cast("string"))
        & F.col("fit_gb").eqNullSafe(F.col("PY_GB").cast("string")),
    )
    return found.groupBy("org", "AH_GE", "AH_GB").agg(F.min(F.struct("fit", "record"))["record"].alias("record"))


def worded_term(record: Column) -> Column:
    """A term record as text; without a record, no days."""
    term = F.coalesce(record["PY_InvoiceTerm"], F.lit(""))
    days = three_places(F.coalesce(record["PY_InvoiceDays"], F.lit(0)))
    return (
        F.when(term.isin("COD", "PIA"), term)
        .when(term == "MIC", F.concat(days, F.lit(" Months "), term))
        .otherwise(F.concat(days, F.lit(" Days "), term))
    )


def credit_term(approved: Column, on_hold: Column) -> Column:
    """Accounts without credit pay on delivery; for the others the term is still open."""
    return F.when((approved == 0) | (on_hold == 1), "COD").otherwise("")


def resolve_terms(keys: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The term of each (AccountPK, SettlementPK, AH_GE, AH_GB) whose account has credit.

    The account's own record counts first. When that says to take the default, the
    record of the settlement group's account does.
    """
    orgs = keys.select(F.explode(F.array("AccountPK", "SettlementPK")).alias("org"), "AH_GE", "AH_GB").distinct()
    best = best_terms(orgs, tables, p)

    def record_of(name: str) -> DataFrame:
        return best.select(
            F.col("org").alias(f"{name}_org"),
            F.col("AH_GE").alias(f"{name}_ge"),
            F.col("AH_GB").alias(f"{name}_gb"),
            F.col("record").alias(name),
        )

    def same(name: str, org: str) -> Column:
        return (
            (F.col(org) == F.col(f"{name}_org"))
            & F.col("AH_GE").eqNullSafe(F.col(f"{name}_ge"))
            & F.col("AH_GB").eqNullSafe(F.col(f"{name}_gb"))
        )

    df = keys.join(record_of("own"), same("own", "AccountPK"), "left")
    df = df.join(record_of("group"), same("group", "SettlementPK"), "left")
    defers = F.coalesce(F.col("own")["PY_InvoiceTerm"], F.lit("")) == "DEF"
    term = F.when(defers, worded_term(F.col("group"))).otherwise(worded_term(F.col("own")))
    return df.select(*keys.columns, term.alias("InvoiceTerm"))
