"""Results that only rows out of the ordinary show."""

from conftest import day
from pyspark.sql import functions as F

from duebook import run_report
from duebook.operators.accounts import has_account_filter
from duebook.operators.credit import exposure_in_groups

RATE = {"RE_GC": "c1", "RE_RX_NKExCurrency": "USD", "RE_StartDate": day("2024-03-01"), "RE_ExpiryDate": day("2024-03-31")}
CREDIT = {"OB_OH": "o1", "OB_GC": "c1", "OB_ARCreditApproved": 1, "OB_AROnCreditHold": 0}


def test_only_the_company_s_rate_types_count(ledger, make):
    rates = [{**RATE, "RE_ExRateType": t, "RE_SellRate": r} for t, r in (("MTH", 1), ("BUY", 2), ("SEL", 3))]
    tables = ledger(AccTransactionHeader=[{"AH_PK": "t1"}], RefExchangeRate=rates)
    assert [r["Balance"] for r in run_report(tables, make(summary_only=True)).collect()] == [100]
    both = make(summary_only=True, exchange_rate_types=("MTH", "BUY"))
    assert [r["Balance"] for r in run_report(tables, both).collect()] == [200]
    none = ledger(AccTransactionHeader=[{"AH_PK": "t1"}], RefExchangeRate=rates, ExchangeRateTypes=[])
    assert run_report(none, make()).first()["PeriodEndRate"] is None


def test_a_settling_account_that_does_not_exist_gives_no_term(ledger, make):
    tables = ledger(
        AccTransactionHeader=[{"AH_PK": "t1"}],
        OrgCompanyData=[CREDIT],
        OrgRelatedParty=[{"PR_OH_Parent": "o1", "PR_OH_RelatedParty": "gone", "PR_GC": "c1", "PR_PartyType": "ARS"}],
        ArTerms=[{"PY_OH": "o1", "PY_InvoiceTerm": "DEF", "PY_InvoiceDays": 0}, {"PY_OH": "gone", "PY_InvoiceTerm": "INV", "PY_InvoiceDays": 45}],
    )
    assert run_report(tables, make()).first()["InvoiceTerm"] == "0 Days "
    assert run_report(tables, make(summary_only=True)).first()["InvoiceTerm"] == "0 Days"


def test_terms_of_transactions_without_account(ledger, make):
    tables = ledger(AccTransactionHeader=[{"AH_PK": "t1", "AH_OH": None}])
    assert run_report(tables, make()).first()["InvoiceTerm"] == "0 Days "
    assert run_report(tables, make(summary_only=True)).first()["InvoiceTerm"] == "0 Days"
    # A list of blanks excludes no country and so keeps them.
    assert not has_account_filter(make(excluded_countries=","))
    assert run_report(tables, make(excluded_countries=",")).count() == 1


def test_days_that_need_more_than_three_places(ledger, make, make_listing):
    tables = ledger(
        AccTransactionHeader=[{"AH_PK": "t1", "AH_InvoiceTermDays": 1234}, {"AH_PK": "t2", "AH_InvoiceTermDays": 999}],
        OrgCompanyData=[CREDIT],
        ArTerms=[{"PY_OH": "o1", "PY_InvoiceTerm": "INV", "PY_InvoiceDays": 1234}],
    )
    terms = {r["TransactionPK"]: r["InvoiceTerm"] for r in run_report(tables, make_listing()).collect()}
    assert terms == {"t1": "INV *   Days", "t2": "INV 999 Days"}
    assert run_report(tables, make()).first()["InvoiceTerm"] == "* Days INV"


def test_absent_flags_are_neither_on_nor_off(ledger, make):
    header = {"AH_PK": "t1", "AH_SystemCreateUser": "AB"}
    tables = ledger(AccTransactionHeader=[header], OrgCompanyData=[{**CREDIT, "OB_ARCreditLimit": 1}])
    row = run_report(tables, make()).first()
    assert (row["IsOverLimit"], row["OperatorInitials"]) == ("*", "")
    row = run_report(tables, make(over_limit_only=None, show_operator=None)).first()
    assert (row["IsOverLimit"], row["OperatorInitials"]) == (None, "AB")
    assert run_report(tables, make(over_limit_only=None, summary_only=True)).first()["IsOverLimit"] is None


def test_exposure_of_many_accounts_in_the_same_three_groups(spark, make):
    from duebook.sources.tables import SCHEMAS, Tables

    n = 3000
    member = F.concat(F.lit("m"), F.col("id"))
    parties = spark.range(n).select(member.alias("PR_OH_Parent"), F.explode(F.array(*[F.lit(h) for h in "xyz"])).alias("PR_OH_RelatedParty"),
                                    F.lit("c1").alias("PR_GC"), F.lit("ARS").alias("PR_PartyType"))
    headers = spark.range(n).select(member.alias("AH_OH"), F.lit(2).cast("decimal(19,4)").alias("AH_OutstandingAmount"), F.lit("c1").alias("AH_GC"),
                                    F.lit("AR").alias("AH_Ledger"), F.lit("INV").alias("AH_TransactionType"))
    data = spark.range(n).select(member.alias("OB_OH"), F.lit(1).alias("OB_ARUseSettlementGroupCreditLimit"))
    given = {"OrgRelatedParty": parties, "AccTransactionHeader": headers, "OrgCompanyData": data}

    def frame(name):
        missing = {c for names in SCHEMAS[name].values() for c in names.split()} - set(given[name].columns)
        return given[name].select("*", *[F.lit(None).alias(c) for c in sorted(missing)])

    out = exposure_in_groups(Tables(frame), make())
    rows = out.collect()
    assert len(rows) == n and {r["exposure"] for r in rows} == {2 * n}
    # No stage puts out more than a few rows for each account and group.
    leaves = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in leaves and "BroadcastNestedLoop" not in leaves


def test_order_of_the_reports(ledger, make):
    headers = [
        {"AH_PK": f"t{i}", "AH_OH": o, "AH_InvoiceDate": day(f"2024-01-0{d}"), "AH_PostDate": day("2024-01-10")}
        for i, (o, d) in enumerate([("o2", 3), ("o1", 9), ("o2", 1), ("o1", 2), ("o3", 5)])
    ]
    orgs = [{"OH_PK": o, "OH_Code": c, "OH_FullName": c} for o, c in (("o1", "ONE"), ("o2", "AAA"), ("o3", "ZZZ"))]
    staff = [{"O8_OH": o, "O8_Role": "SAL", "O8_Department": "ALL", "O8_GS_NKPersonResponsible": g} for o, g in (("o1", "G3"), ("o2", "G2"), ("o3", "G1"))]
    parties = [{"PR_OH_Parent": "o1", "PR_OH_RelatedParty": "o3", "PR_GC": "c1", "PR_PartyType": "ARS"}]
    names = [{"GS_Code": g, "GS_FullName": n} for g, n in (("G1", "Ann"), ("G2", "Bob"), ("G3", "Cid"))]
    tables = ledger(AccTransactionHeader=headers, OrgHeader=orgs, StaffAssignments=staff, GlbStaff=names, OrgRelatedParty=parties)
    assert [r["TransactionPK"] for r in run_report(tables, make()).collect()] == ["t2", "t0", "t3", "t1", "t4"]
    by = lambda **more: [r["AccountCode"] for r in run_report(tables, make(summary_only=True, **more)).collect()]
    assert by() == ["AAA", "ONE", "ZZZ"]
    assert by(order_by="SalesRepName") == ["ZZZ", "AAA", "ONE"]
    assert by(order_by="SettlementCode") == ["AAA", "ONE", "ZZZ"]
