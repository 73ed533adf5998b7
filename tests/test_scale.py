"""What must hold at any size: rows that operators put out, shuffles, storage, ordered parts, lookups."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_accounts import brute_force_exposure, orgs, rows

from checks.scenarios import listing, params
from duebook import run_report
from duebook.operators import credit, matching
from duebook.operators.headers import reported_headers
from duebook.operators.lines import with_line_amounts
from duebook.operators.matching import with_balance
from duebook.params import ORDER_BY_NUMBER, ORDER_BY_POST_DATE
from duebook.plans.context import build_context
from duebook.plans.report import read_page, write_report
from duebook.sources.sample import sample_tables, sample_views
from duebook.sources.snapshots import MatchSnapshots, with_matched
from duebook.sources.storage import Layout, store, store_table, stored
from duebook.sources.tables import SCHEMAS, Tables

FOLDER = "/root/testdata/sf0.001"


def nodes(plan):
    """All operators of a plan that has run, those below a reused shuffle left out."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    else:
        yield plan
        if "Reused" not in kind:
            children = plan.children()
            for i in range(children.size()):
                yield from nodes(children.apply(i))


def executed(df):
    df.collect()
    return list(nodes(df._jdf.queryExecution().executedPlan()))


def most_rows(plan):
    found = [p.metrics().get("numOutputRows") for p in plan]
    return max(m.get().value() for m in found if m.isDefined())


def kinds(plan):
    return [p.nodeName() for p in plan]


# ---- settlement exposure ------------------------------------------------------------------------------------------


def exposure_tables(spark, parties, n):
    member = F.concat(F.lit("m"), F.col("id"))
    headers = spark.range(n).select(
        member.alias("AH_OH"), F.lit(2).cast("decimal(19,4)").alias("AH_OutstandingAmount"), F.lit("c1").alias("AH_GC"),
        F.lit("AR").alias("AH_Ledger"), F.lit("INV").alias("AH_TransactionType"))
    data = spark.range(n).select(member.alias("OB_OH"), F.lit(1).alias("OB_ARUseSettlementGroupCreditLimit"))
    heads = spark.range(n).select(member.alias("PR_OH_Parent"), F.explode(parties).alias("PR_OH_RelatedParty"), F.lit("c1").alias("PR_GC"), F.lit("ARS").alias("PR_PartyType"))
    given = {"OrgRelatedParty": heads, "AccTransactionHeader": headers, "OrgCompanyData": data}

    def frame(name):
        missing = {c for names in SCHEMAS[name].values() for c in names.split()} - set(given[name].columns)
        return given[name].select("*", *[F.lit(None).alias(c) for c in sorted(missing)])

    return Tables(frame)


def test_exposure_rows_are_linear_where_all_combinations_differ(spark, make):
    n = 600
    heads = F.array(F.lit("A"), F.lit("B"), F.concat(F.lit("own"), F.col("id")))
    out = credit.exposure_in_groups(exposure_tables(spark, heads, n), make())
    plan = executed(out)
    assert {r["exposure"] for r in out.collect()} == {2 * n} and out.count() == n
    assert most_rows(plan) < 10_000


@pytest.mark.parametrize(("seed", "few"), [(4, 6), (5, 2), (6, 1), (7, 0)])
def test_exposure_with_many_heads_matches_brute_force(ledger, make, monkeypatch, seed, few):
    """Subsets up to `few` heads, looked up beyond; a third of the accounts in one group, combinations of up to seven."""
    monkeypatch.setattr(credit, "FEW_HEADS", few)
    draw = random.Random(seed)
    keys = [f"k{n:02d}" for n in range(20)]
    parties = [(k, "k00") for k in keys[:8]] + [(k, h) for k in keys for h in draw.sample(keys, draw.choice([0, 1, 1, 2, 3, 7]))]
    users = set(draw.sample(keys, 16))
    headers = [{"AH_PK": f"t{n}", "AH_OH": draw.choice(keys[:16]), "AH_OutstandingAmount": draw.randint(-50, 90)} for n in range(50)]
    tables = ledger(
        OrgHeader=orgs(*keys),
        OrgRelatedParty=[{"PR_OH_Parent": a, "PR_OH_RelatedParty": b, "PR_GC": "c1", "PR_PartyType": "ARS"} for a, b in parties],
        OrgCompanyData=[{"OB_OH": k, "OB_GC": "c1", "OB_ARUseSettlementGroupCreditLimit": int(k in users)} for k in keys],
        AccTransactionHeader=headers,
    )
    owed = defaultdict(int)
    for h in headers:
        owed[h["AH_OH"]] += h["AH_OutstandingAmount"]
    in_group, _ = brute_force_exposure(parties, users, owed)
    assert {k: v[0] for k, v in rows(credit.exposure_in_groups(tables, make()), "account", "exposure").items()} == in_group


# ---- the detail report and the ageing summary ---------------------------------------------------------------------


def header_scans(plan):
    return sum("acctransactionheader" in p.toString().lower() and "Scan" in p.nodeName() for p in plan if not p.children().size())


@pytest.mark.parametrize("p", [params(order_by=ORDER_BY_POST_DATE), params("AP"), listing(order_by=ORDER_BY_NUMBER)])
def test_detail_reads_its_transactions_once(spark, p):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = executed(run_report(sample_tables(spark, FOLDER), p))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One for the transactions, one for what accounts owe now.
    assert header_scans(plan) <= 2
    assert any("Reused" in k for k in kinds(plan))


def test_ageing_summary_scans_headers_at_most_three_times(spark):
    assert header_scans(executed(run_report(sample_tables(spark, FOLDER), params(summary_only=True)))) <= 3


def test_a_hot_account_is_many_tasks(ledger, make, spark):
    headers = [{"AH_PK": f"t{i}", "AH_OH": "o1" if i % 3 == 0 else f"x{i}"} for i in range(300)] + [{"AH_PK": f"n{i}", "AH_OH": None} for i in range(100)]
    tables = ledger(AccTransactionHeader=headers)
    from duebook.operators.transactions import ledger_transactions
    from duebook.plans.detail import ACCOUNT_PARTS, KEY, PART, dealt

    p = make()
    rows_ = dealt(ledger_transactions(tables, p, build_context(tables, p)), p)
    found = {r[KEY]: r["n"] for r in rows_.groupBy(KEY).agg(F.count_distinct(PART).alias("n")).collect()}
    assert found["=o1"] > ACCOUNT_PARTS / 2 and found[""] > ACCOUNT_PARTS / 2


def test_profiles_are_repeated_for_parts_in_use_only(ledger, make, spark):
    n = 200
    headers = [{"AH_PK": f"t{i}", "AH_OH": f"o{i}"} for i in range(n)]
    tables = ledger(AccTransactionHeader=headers, OrgHeader=orgs(*[f"o{i}" for i in range(n)]))
    for p in (make(), make(all_transactions=True, transaction_types="INV")):
        out = run_report(tables, p)
        assert sorted(r["AccountCode"] for r in out.collect()) == sorted(r["OH_Code"] for r in tables["OrgHeader"].collect())
        assert most_rows(executed(out)) < 10 * n


# ---- storage ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("store")), "teststore", 4)
    return layout, store(sample_views(spark, FOLDER), layout)


def test_stored_tables_are_the_tables(spark, stored_tables):
    layout, tables = stored_tables
    views = sample_views(spark, FOLDER)
    for name in ("AccTransactionHeader", "AccTransactionMatchLink", "OrgHeader", "AccCollectionOrderLine"):
        assert tables[name].columns == views[name].columns == stored(spark, layout)[name].columns
        assert tables[name].dtypes == views[name].dtypes
        assert tables[name].exceptAll(views[name]).isEmpty() and tables[name].count() == views[name].count()


def test_joins_by_transaction_need_no_shuffle(spark, stored_tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for p in (params(), listing(line_amounts=True)):
            ctx = build_context(stored_tables[1], p)
            headers = reported_headers(stored_tables[1], p, ctx)
            df = with_balance(headers, stored_tables[1], p, ctx)
            df = with_line_amounts(df.withColumn("TransactionPK", F.col("AH_PK")).withColumn("TransactionType", F.col("AH_TransactionType")), stored_tables[1], p)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hash" not in plan, plan
            assert "PartitionFilters: [" in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_store_table_keeps_missing_keys(spark, tmp_path):
    df = spark.sql("select * from values (1, 2.5), (null, 1.0), (1, null) as t(AL_AH, AL_LineAmount)").withColumn("AL_GSTVAT", F.lit(None).cast("decimal(19,4)"))
    got = store_table(df, "AccTransactionLines", Layout(str(tmp_path), "testmissing", 3))
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def test_sample_receivables_read_and_store_no_payables(spark):
    tables, views = sample_tables(spark, FOLDER), sample_views(spark, FOLDER)
    for ledger_, stored_ in (("AR", False), ("AP", True)):
        own = F.col("AH_Ledger") == ledger_
        plan = executed(tables["AccTransactionHeader"].filter(own).select("AH_PK", "AH_LocalTotal"))
        scans = " ".join(p.toString() for p in plan if "Scan" in p.nodeName())
        assert ("l_suppkey" in scans, "_payables" in scans) == (False, stored_)
        assert not any("Exchange" in k for k in kinds(plan) if "Broadcast" not in k)
    for name in ("AccTransactionHeader", "AccTransactionMatchLink"):
        assert tables[name].dtypes == views[name].dtypes and tables[name].count() == views[name].count()
        assert tables[name].exceptAll(views[name]).isEmpty()


# ---- match groups, ordered parts, lookups -------------------------------------------------------------------------


def test_a_match_group_of_a_third_of_all_links(ledger, make):
    p = make(future_matches_apart=True)
    late, early = "2024-05-01", "2024-01-10"
    headers = [{"AH_PK": "rec", "AH_TransactionType": "REC", "AH_PostDate": F_day(late)}] + [{"AH_PK": f"t{i}", "AH_PostDate": F_day(early)} for i in range(200)]
    links = [{"AP_AH": "rec", "AP_MatchGroupNum": "hot", "AP_Amount": 1, "AP_MatchDate": F_day(late)}]
    links += [{"AP_AH": f"t{i}", "AP_MatchGroupNum": "hot" if i % 3 == 0 else f"g{i}", "AP_Amount": i, "AP_MatchDate": F_day(early)} for i in range(200)]
    links += [{"AP_AH": "t3", "AP_MatchGroupNum": "hot", "AP_Amount": 1000, "AP_MatchDate": F_day(early)}, {"AP_AH": "t3", "AP_MatchGroupNum": None, "AP_Amount": 7}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    df = matching.future_matches(tables, p, build_context(tables, p))
    got = {r["AP_AH"]: int(r["future_matched"]) for r in df.collect()}
    assert got == {"rec": 1, **{f"t{i}": i for i in range(0, 200, 3)}, "t3": 1003}
    assert re.search(r"Join \[.*AP_MatchGroupNum.*pmod\(xxhash64\(AP_AH|Join \[.*AP_MatchGroupNum.*link_part", df._jdf.queryExecution().toString())


def test_parts_of_match_groups_are_not_broadcast(ledger, make):
    p = make(future_matches_apart=True)
    headers = [{"AH_PK": f"r{i}", "AH_TransactionType": "REC", "AH_PostDate": F_day("2024-05-01")} for i in range(20)]
    links = [{"AP_AH": f"r{i}", "AP_MatchGroupNum": f"g{i}", "AP_Amount": i} for i in range(20)]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    plan = executed(matching.future_matches(tables, p, build_context(tables, p)))
    joins = [x for x in plan if "Join" in x.nodeName() and "group_part" in x.simpleString(1000)]
    assert [x.nodeName() for x in joins] == ["SortMergeJoin"]


def F_day(text):
    from conftest import day

    return day(text)


@pytest.mark.parametrize("p", [params(order_by=ORDER_BY_POST_DATE), params(summary_only=True)])
def test_ordered_parts(spark, tmp_path, p):
    tables, path = sample_tables(spark, FOLDER), str(tmp_path / "report")
    whole = run_report(tables, p).collect()
    bounds = write_report(tables, p, path, 5).collect()
    assert sum(b["rows"] for b in bounds) == len(whole) and len(bounds) > 1
    spread = spark.read.parquet(f"{path}/boundaries").orderBy("part").select(F.col("last") <= F.lead("first").over(__import__("pyspark").sql.Window.orderBy("part"))).collect()
    assert all(r[0] in (True, None) for r in spread)
    at = bounds[0]["rows"] - 2
    assert read_page(spark, path, 0, 10**6).collect() == whole
    assert read_page(spark, path, at, 5).collect() == whole[at : at + 5]
    assert read_page(spark, path, len(whole), 5).collect() == []


def test_lookups_of_several_rows_fail(ledger, make):
    company = {"GC_PK": "c1", "GC_RN_NKCountryCode": "AU", "GC_IsReciprocal": False}
    with pytest.raises(ValueError, match="more than one company"):
        build_context(ledger(GlbCompany=[company, {**company, "GC_RN_NKCountryCode": "NZ"}]), make())
    period = {"AM_PERIOD": 202403, "AM_GC_COMPANY": "c1", "AM_StartDate": F_day("2024-03-01"), "AM_EndDate": F_day("2024-03-31")}
    tables = ledger(AccPeriodManagement=[period, {**period, "AM_EndDate": F_day("2024-03-30")}])
    for ageing in ("PER", "DAY"):
        with pytest.raises(ValueError, match="more than one"):
            build_context(tables, make(ageing_dates=None, ageing_option=ageing, period=202403))


# ---- snapshots ----------------------------------------------------------------------------------------------------


def matched_at(headers, terms):
    return {r["AH_PK"]: r["matched"] for r in with_matched(headers, terms).collect() if r["matched"]}


def test_snapshots_give_what_the_links_give(spark, ledger, tmp_path):
    draw, days = random.Random(3), [F_day(f"2024-{m:02d}-{d:02d}") for m in range(1, 13) for d in (1, 15, 28)]
    links = [{"AP_AH": draw.choice(["a", "b", "c", None]), "AP_Amount": draw.randint(-9, 90), "AP_MatchDate": draw.choice([*days, None])} for _ in range(60)]
    late = [{"AP_AH": draw.choice("abcd"), "AP_Amount": draw.randint(1, 90), "AP_MatchDate": draw.choice(days)} for _ in range(25)]
    headers = spark.sql("select * from values ('a'), ('b'), ('c'), ('d'), ('e') as t(AH_PK)")
    ends = [F_day("2024-03-31"), F_day("2024-06-15"), F_day("2024-09-30")]
    made = MatchSnapshots.build(ledger(AccTransactionMatchLink=links), Layout(str(tmp_path), "testsnap", 3), ends)
    for more in ([], late):
        if more:
            made.append(ledger(AccTransactionMatchLink=more)["AccTransactionMatchLink"])
        own = [x for x in [*links, *more] if x["AP_AH"] and x["AP_MatchDate"]]
        for at in [F_day("2023-12-31"), *days[::4], *ends, F_day("2025-01-01")]:
            want = defaultdict(int), defaultdict(int)
            for x in own:
                want[x["AP_MatchDate"] > at][x["AP_AH"]] += x["AP_Amount"]
            for terms, sums in zip((made.terms_upto(at), made.terms_after(at)), want):
                assert matched_at(headers, terms) == {k: v for k, v in sums.items() if v}, (at, bool(more))


def test_snapshots_are_summed_where_their_links_lie(spark, ledger, tmp_path, monkeypatch):
    plans, write = [], MatchSnapshots._store
    monkeypatch.setattr(MatchSnapshots, "_store", lambda self, df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(self, df, *a)))
    links = [{"AP_AH": f"t{i % 7}", "AP_Amount": i, "AP_MatchDate": F_day(f"2024-0{i % 5 + 1}-01")} for i in range(40)]
    made = MatchSnapshots.build(ledger(AccTransactionMatchLink=links), Layout(str(tmp_path), "testlie", 3), [F_day("2024-02-28"), F_day("2024-12-31")])
    assert [p.count("Exchange") for p in plans] == [1, 0]
    assert sum(r["amount"] for r in made._snapshot(F_day("2024-12-31")).collect()) == sum(range(40))


def test_snapshots_read_only_the_months_since_and_shuffle_nothing(spark, stored_tables, tmp_path):
    layout, tables = stored_tables
    made = MatchSnapshots.build(tables, Layout(str(tmp_path), "testmonths", layout.buckets), [F_day("1997-12-31"), F_day("1996-12-31")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = listing(post_date_to=F_day("1998-02-28"))
        df = with_balance(tables["AccTransactionHeader"], tables.with_snapshots(made), p, build_context(tables, p))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hash" not in plan and "AP_Month" in plan and "19971231000000" in plan
    assert df.exceptAll(with_balance(tables["AccTransactionHeader"], tables, p, build_context(tables, p)).select(*df.columns)).isEmpty()
