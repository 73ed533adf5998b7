"""What the detail report puts on disk: each transaction is shuffled once by account, with no column that others tell."""

import pytest
from conftest import day
from pyspark.sql import functions as F
from test_accounts import orgs
from test_scale import FOLDER, executed

from checks.scenarios import listing, params
from duebook import run_report
from duebook.operators.dimensions import with_job, with_job_by_key
from duebook.operators.headers import reported_headers
from duebook.operators.transactions import base_transactions, ledger_transactions
from duebook.params import ORDER_BY_NUMBER
from duebook.plans import detail
from duebook.plans.context import build_context
from duebook.sources.sample import sample_tables


def exchanges(plan):
    return [p for p in plan if p.nodeName() == "Exchange"]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("p", [listing(order_by=ORDER_BY_NUMBER, line_amounts=True, overdue_only=True), params(disbursement_only=True)])
def test_filtered_reports_deal_their_transactions_once(spark, no_broadcast, p):
    found = exchanges(executed(run_report(sample_tables(spark, FOLDER), p)))
    assert sum("account_part" in x.simpleString(10000) and "REPARTITION_BY_COL" in x.simpleString(10000) for x in found) == 1
    # The transactions are not shuffled anew when they meet their accounts.
    assert not any("asked" in x.simpleString(10000) and "ENSURE_REQUIREMENTS" in x.simpleString(10000) and "TransactionPK" in x.output().toString() for x in found)


def test_no_shuffle_carries_what_other_columns_tell(spark, no_broadcast):
    df = run_report(sample_tables(spark, FOLDER), listing(order_by=ORDER_BY_NUMBER, line_amounts=True, local_equivalent=True))
    assert detail.TOLD_BY_OTHERS < set(df.columns)
    carried = " ".join(x.output().toString() for x in exchanges(executed(df)))
    assert "InvoiceRef" in carried
    assert not [c for c in detail.TOLD_BY_OTHERS if f"{c}#" in carried]


@pytest.mark.parametrize("more", [{"all_transactions": True, "transaction_types": "INV", "order_by": ORDER_BY_NUMBER}, {}])
def test_overdue_rows_are_those_of_the_whole_report(ledger, make, more):
    now, due = day("2024-03-31"), [day("2024-03-01"), day("2024-05-01"), None]
    headers = [{"AH_PK": f"t{i}", "AH_OH": [None, "o1", "o2", "gone"][i % 4], "AH_DueDate": due[i % 3], "AH_TransactionCategory": "DBT" if i % 2 else ""} for i in range(60)]
    parties = [{"PR_OH_Parent": "o1", "PR_OH_RelatedParty": o, "PR_GC": "c1", "PR_PartyType": "ARS"} for o in ("o2", "o3")]
    data = [{"OB_OH": o, "OB_GC": "c1", "OB_ARCreditLimit": 1200} for o in ("o1", "o2")]
    tables = ledger(AccTransactionHeader=headers, OrgHeader=orgs("o1", "o2", "o3"), OrgRelatedParty=parties, OrgCompanyData=data)
    whole = run_report(tables, make(**more)).collect()
    # Not all rows of an account over its limit are overdue; the mark counts them all the same.
    assert any(r["IsOverLimit"] for r in whole) and (more or any(r["AccountCode"] is None for r in whole))
    assert run_report(tables, make(overdue_only=True, **more)).collect() == [r for r in whole if r["DueDate"] and r["DueDate"] <= now]
    assert run_report(tables, make(disbursement_only=True, **more)).collect() == [r for r in whole if r["DSBCharge"]]


def test_only_busy_accounts_are_dealt_to_parts(ledger, make, monkeypatch):
    monkeypatch.setattr(detail, "BUSY_ACCOUNTS", 1)
    headers = [{"AH_PK": f"t{i}", "AH_OH": "hot" if i % 2 else f"o{i % 10}"} for i in range(300)] + [{"AH_PK": f"n{i}", "AH_OH": None} for i in range(100)]
    tables, p = ledger(AccTransactionHeader=headers, OrgHeader=orgs("hot", "o0", "o2", "o4", "o6")), make()
    ctx = build_context(tables, p)
    dealt = detail.dealt(ledger_transactions(tables, p, ctx), p, detail.busy_accounts(tables, p, ctx))
    found = {r[detail.KEY]: r["n"] for r in dealt.groupBy(detail.KEY).agg(F.count_distinct(detail.PART).alias("n")).collect()}
    assert min(found.pop("=hot"), found.pop("")) > detail.ACCOUNT_PARTS / 2
    assert set(found.values()) == {1} and len(found) == 5
    got = {r["TransactionPK"]: r["AccountCode"] for r in run_report(tables, p).collect()}
    assert got == {h["AH_PK"]: None if h["AH_OH"] in (None, "o8") else h["AH_OH"].upper() for h in headers}


def test_jobs_by_key_are_the_jobs(ledger, make_listing):
    jobs = ["j1", "j2", None, "j3", "gone", "j4"]
    headers = [{"AH_PK": None if i % 7 == 3 else f"t{i % 11}", "AH_JH": jobs[i % 6], "AH_TransactionNum": f"n{i}"} for i in range(66)]
    names = [("j1", "one"), ("j2", "two"), ("j2", "second"), ("j2", "second"), ("j3", None), (None, "none"), ("j4", "four")]
    tables, p = ledger(AccTransactionHeader=headers, JobHeader=[{"JH_PK": k, "JH_JobNum": n} for k, n in names]), make_listing()
    ctx = build_context(tables, p)
    rows = base_transactions(tables, p, ctx, jobs=False)
    want = with_job(rows, tables, p)
    got = with_job_by_key(rows, reported_headers(tables, p, ctx), tables, p)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.count() > 66 and want.filter("TransactionPK is null and JobNumber = 'second'").count() > 0
