"""Queries against their SQL, and what their plans must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from checks.scenarios import ORACLE, QUERIES, listing, params
from duebook import run_report
from duebook.operators.accounts import BASE_PARTS, account_profile
from duebook.operators.headers import reported_headers
from duebook.operators.transactions import ledger_transactions
from duebook.plans.context import build_context
from duebook.plans.detail import join_profile
from duebook.sources.sample import sample_tables
from duebook.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "ageing_due", "ageing_period_dates", "ageing_summary_branch", "ageing_summary_currency", "average_exchange_rate",
    "collection_batch_filter", "contact_phone", "credit_over_limit_mark", "detail_trn", "future_match_exclude",
    "invoice_term_best_match", "line_amounts", "multi_list_filter", "restate_reciprocal", "revaluation_detail",
    "sales_rep_semi_join", "settlement_over_limit", "summary_sales_rep",
]
REPORTS = {
    "detail": params(in_invoice_currency=True, future_matches_apart=True, line_amounts=True, match_status_text=True),
    "payables detail": params("AP", branch_management_code="G0", sales_rep="S01"),
    "summary": params(summary_only=True, in_invoice_currency=True),
    "listing": listing(line_amounts=True, order_by="TRN"),
    "listing summary": listing(summary_only=True, group_by="Customer Service Rep"),
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", CHECKED)
def test_same_as_sql(spark, key):
    text, rows = differences(spark, FOLDER, key)
    assert not text and rows


def plan(df) -> str:
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", REPORTS)
def test_plans_join_by_keys_and_stay_in_the_jvm(spark, name):
    text = plan(run_report(sample_tables(spark, FOLDER), REPORTS[name]))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert operator not in text


def test_header_filters_reach_the_scan(spark, tmp_path):
    p = params()
    base, home = sample_tables(spark, FOLDER), str(tmp_path / "headers")
    base["AccTransactionHeader"].write.partitionBy("AH_Ledger").parquet(home)
    tables = Tables(lambda name: spark.read.parquet(home) if name == "AccTransactionHeader" else base[name])
    text = plan(reported_headers(tables, p, build_context(tables, p)).select("AH_PK"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    for column in ("AH_GC", "AH_PostDate", "AH_FullyPaidDate", "AH_TransactionType"):
        assert column in pushed
    assert re.search(r"PartitionFilters: \[[^\]]*AH_Ledger[^\]]* = AR\)", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "AH_Desc" not in schema and "AH_OSTotal" not in schema


def test_current_balances_read_no_match_links(spark):
    text = plan(run_report(sample_tables(spark, FOLDER), params(current_date_time=params().now)))
    assert "AP_MatchDate" not in text


def test_no_result_depends_on_broadcasts_and_a_hot_account_is_split(spark):
    """A third of all transactions on one account, with every join shuffled."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    base = sample_tables(spark, "/root/testdata/sf0.01")
    hot = base["AccTransactionHeader"].withColumn("AH_OH", F.when(F.col("AH_PK") % 3 == 0, 5).otherwise(F.col("AH_OH")))
    tables = Tables(lambda name: hot if name == "AccTransactionHeader" else base[name])
    p = listing(line_amounts=True)

    def report():
        ctx = build_context(tables, p)
        df = ledger_transactions(tables, p, ctx)
        return join_profile(df, account_profile(tables, p, ctx, BASE_PARTS), p)

    expected = sorted(map(repr, report().collect()))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = report()
        assert sorted(map(repr, df.collect())) == expected
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text and "BroadcastHashJoin" not in text
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
