"""Small lookups joined to transactions: branch, department, currency, job, status texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import in_list, join_sparse
from duebook.params import ReportParams
from duebook.sources.tables import Tables, of_company


def managed_branch_codes(tables: Tables, p: ReportParams) -> DataFrame:
    """Codes of the branches of a management group, within the branch list if there is one.

    The branch list counts as the text it is: a code is in it where the text contains it.
    """
    branches = tables["GlbBranch"].filter(
        (F.col("GB_GC") == F.lit(p.company))
        & (F.col("GB_AccountingGroupCode") == p.branch_management_code)
        & (F.col("GB_Code") != "")
    )
    if p.branches is not None:
        listed = F.lit(",".join(p.branches))
        branches = branches.filter(F.instr(listed, F.col("GB_Code")) > 0)
    return branches.select(F.col("GB_Code").alias("managed_code"))


def with_branch(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Branch of the transaction. The listing drops transactions without one, ageing keeps them."""
    branches = tables["GlbBranch"].select(
        F.col("GB_PK"), F.col("GB_Code").alias("BranchCode"), F.col("GB_BranchName").alias("TranBranchName")
    )
    filtered = True
    if p.branch_management_code:
        branches = branches.join(
            managed_branch_codes(tables, p), F.col("BranchCode") == F.col("managed_code"), "left_semi"
        )
    elif p.branches is not None:
        branches = branches.filter(in_list(F.col("BranchCode"), p.branches))
    else:
        filtered = False
    how = "inner" if filtered or p.all_transactions else "left"
    return df.join(branches, F.col("AH_GB") == F.col("GB_PK"), how).drop("GB_PK")


def with_department(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Department of the transaction: required and shown by the listing, not looked at by ageing."""
    if not p.all_transactions:
        return df.withColumn("DepartmentCode", F.lit(None).cast("string"))
    departments = tables["GlbDepartment"].withColumnRenamed("GE_Code", "DepartmentCode")
    return df.join(departments, F.col("AH_GE") == F.col("GE_PK")).drop("GE_PK")


def with_currency(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Currency of the transaction. The listing drops transactions without one, ageing keeps them."""
    currency = tables["RefCurrency"].select(
        F.col("RX_PK").alias("CurrencyPK"),
        F.col("RX_Code").alias("CurrencyCode"),
        F.col("RX_SubUnitRatio").alias("RXSubUnitRatio"),
    )
    how = "inner" if p.all_transactions or p.currencies is not None else "left"
    df = df.join(currency, F.col("AH_RX_NKTransactionCurrency") == F.col("CurrencyCode"), how)
    return df if p.currencies is None else df.filter(in_list(F.col("CurrencyCode"), p.currencies))


def with_job(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Job number. The listing only."""
    if not p.all_transactions:
        return df.withColumn("JobNumber", F.lit(None).cast("string"))
    jobs = tables["JobHeader"].withColumnRenamed("JH_JobNum", "JobNumber")
    return join_sparse(df, jobs, "AH_JH", "JH_PK", "TransactionPK")


def with_job_by_key(df: DataFrame, headers: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The same as `with_job`, for transactions of these headers that lie by their key: only keys are shuffled by the job.

    A transaction's key gets the numbers of all its jobs, as several headers may share it, and the row takes those of its
    own job. Rows without a key, of which there are hardly any, look their job up by themselves.
    """
    if not p.all_transactions:
        return df.withColumn("JobNumber", F.lit(None).cast("string"))
    keyed, job = F.col("AH_PK").isNotNull(), F.col("AH_JH").isNotNull()
    jobs = tables["JobHeader"].withColumnRenamed("JH_JobNum", "JobNumber")
    named = headers.filter(keyed & job).select(F.col("AH_PK").alias("job_of"), F.col("AH_JH").alias("job")).distinct()
    numbers = named.join(jobs, F.col("job") == F.col("JH_PK")).groupBy("job_of").agg(F.collect_list(F.struct("job", "JobNumber")).alias("jobs"))
    own = F.explode_outer(F.filter("jobs", lambda j: j["job"] == F.col("AH_JH")))
    df = df.join(numbers, F.col("TransactionPK") == F.col("job_of"), "left").withColumn("own_job", own).drop("job_of", "jobs")

    lacking = headers.filter(~keyed & job).select("AH_JH")
    alone = jobs.join(lacking, F.col("JH_PK") == F.col("AH_JH"), "left_semi")
    df = df.withColumn("lone_job", F.when(F.col("TransactionPK").isNull(), F.col("AH_JH")))
    df = join_sparse(df, alone, "lone_job", "JH_PK", "TransactionPK")
    number = F.coalesce(F.col("own_job")["JobNumber"], F.col("JobNumber"))
    return df.withColumn("JobNumber", number).drop("own_job", "lone_job")


def with_match_status_text(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Append the description to match status and reason, where there is one."""
    if not p.match_status_text:
        return df
    for column, table in (("MatchStatus", "MatchStatus"), ("MatchStatusReason", "MatchStatusReason")):
        texts = of_company(tables[table], "GC", p.company).select(
            F.col("Code").alias("status_code"), F.col("Description").alias("status_text")
        )
        code, text = F.col(column), F.col("status_text")
        df = (
            df.join(texts, code == F.col("status_code"), "left")
            .withColumn(column, F.when(text.isNull(), code).otherwise(F.concat(code, F.lit(" - "), text)))
            .drop("status_code", "status_text")
        )
    return df


def with_operator_initials(df: DataFrame, p: ReportParams) -> DataFrame:
    """Blank the operator's initials unless the detail report asks for them."""
    hidden = p.summary_only or p.show_operator is False
    return df.withColumn("OperatorInitials", F.lit("")) if hidden else df
