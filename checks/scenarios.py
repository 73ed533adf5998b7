"""Every operator as a query over the sample tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.oracle import JUNE, KINDS, select_ageing_summary, select_listing_summary, select_revalued, select_working
from duebook import BLANK_DATE, ReportParams, run_report
from duebook.functions.ageing import BUCKETS, LOCAL_SUFFIX, period_boundaries
from duebook.operators import contacts, credit, matching
from duebook.operators.accounts import BASE_PARTS, CREDIT, account_base, account_profile
from duebook.operators.contacts import NO_CONTACT
from duebook.operators.currency import with_period_end_rate, with_revaluation
from duebook.operators.headers import of_ledger, overdue, reported_headers
from duebook.operators.transactions import base_transactions, disbursement_kept, ledger_amounts, ledger_transactions
from duebook.params import (
    ORDER_BY_INVOICE_DATE,
    ORDER_BY_NUMBER,
    ORDER_BY_POST_DATE,
    ORDER_BY_TRANSACTION,
    ORDER_BY_TYPE,
)
from duebook.plans.context import RunContext, build_context, company_context
from duebook.plans.detail import join_profile, with_invoice_term, with_term_lists, working_set
from duebook.sources.sample import sample_tables, sample_with_snapshots
from duebook.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DAY = datetime(1998, 6, 30)
LATER = datetime(2001, 12, 31)
ALL_TYPES = "INV,CRD,ADJ,REC,PAY"


def params(ledger: str = "AR", **more) -> ReportParams:
    """Open items as of the report day, looked back at from later."""
    values = {"company": 1, "ledger": ledger, "current_date_time": LATER, "period": 199806, "now": REPORT_DAY}
    return ReportParams(**{**values, **more})


def listing(ledger: str = "AR", **more) -> ReportParams:
    """All transactions up to the report day."""
    values = {
        "all_transactions": True,
        "transaction_types": ALL_TYPES,
        "period": 0,
        "post_date_to": REPORT_DAY,
        "ageing_dates": JUNE,
    }
    return params(ledger, **{**values, **more})


# ---- results in comparable form -------------------------------------------------------------


def plain(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Amounts as doubles of fixed decimals, days as text, counts as bigint."""
    digits = digits or {}
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            n = digits.get(name, 9 if kind == "decimal(18,9)" else 4)
            column = F.round(column, n).cast("double")
        elif kind == "timestamp_ntz":
            column = F.date_format(column, "yyyy-MM-dd")
        elif KINDS.get(name) == "int":
            column = column.cast("bigint")
        columns.append(column.alias(name))
    return df.select(*columns)


Build = Callable[[Tables, ReportParams, RunContext], DataFrame]


def scenario(build: Build, p: ReportParams, reciprocal: bool = False, digits: dict[str, int] | None = None, source=sample_tables) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = source(spark, folder, reciprocal)
        return plain(build(tables, p, build_context(tables, p)), digits)

    return run


def rows(columns: str, stage=base_transactions, parts: frozenset[str] = BASE_PARTS) -> Build:
    """Transactions up to a stage, joined to account attributes."""

    def build(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        wanted = parts | {CREDIT} if p.over_limit_only else parts
        df = stage(tables, p, ctx)
        if "DSBCharge" in df.columns:
            df = df.filter(disbursement_kept(p))
        joined = join_profile(df, account_profile(tables, p, ctx, frozenset(wanted)), p)
        return joined.select(*columns.split())

    return build


def terms(columns: str) -> Build:
    def build(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        rows = base_transactions(tables, p, ctx, jobs=False)
        profile = with_term_lists(account_profile(tables, p, ctx, BASE_PARTS), rows, tables, p)
        return with_invoice_term(join_profile(rows, profile, p)).select(*columns.split())

    return build


def complete(columns: str, parts: frozenset[str] = BASE_PARTS) -> Build:
    """The detail report's rows; parts not asked for are left null and not selected."""

    def build(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        return working_set(tables, p, ctx, parts).select(*columns.split())

    return build


def report(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    return run_report(tables, p)


def detail(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    return run_report(tables, p).select(*KINDS)


def revalued_rows(columns: str) -> Build:
    def build(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        df = join_profile(ledger_amounts(tables, p, ctx, jobs=False), account_profile(tables, p, ctx, BASE_PARTS), p)
        df = with_period_end_rate(df, tables, p, ctx, always=True)
        return with_revaluation(df, p, ctx).select(*columns.split())

    return build


# ---- the queries -----------------------------------------------------------------------------

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(key: str, query: Query, sql: str) -> None:
    QUERIES[key] = query
    ORACLE[key] = sql


def add_rows(key: str, columns: str, p: ReportParams, build=None, reciprocal: bool = False, where: str = "true", source=sample_tables) -> None:
    """A query whose rows are transactions, against the step-by-step SQL; where: of the SQL's rows only."""
    build = build or rows(columns)
    add(key, scenario(build, p, reciprocal, source=source), select_working(p, columns.split(), reciprocal, where))


def sql(select: str, p: ReportParams | None = None) -> str:
    return oracle.query(oracle.working(p) if p else [], select)


BASIC = "TransactionPK AccountCode TransactionType Balance"
LIST_BASIC = "TransactionPK AccountCode TransactionType InvoiceTotal Balance"


def _lookups() -> None:
    def company(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        country, reciprocal = company_context(tables, p)
        counts = of_ledger(tables["AccTransactionHeader"], p).groupBy("AH_GC").agg(F.count(F.lit(1)).alias("transactions"))
        return counts.select("AH_GC", "transactions", F.lit(country).alias("country"), F.lit(reciprocal).alias("reciprocal"))

    add(
        "company_context",
        scenario(company, params()),
        sql(
            "select AH_GC, count(*) as transactions, GC_RN_NKCountryCode as country, GC_IsReciprocal as reciprocal "
            "from AccTransactionHeader join GlbCompany on GC_PK = AH_GC where AH_GC = 1 and AH_Ledger = 'AR' group by all"
        ),
    )
    starts = {"p1_start": "lag", "p1_plus_start": "lead"}
    neighbours = [("p1_start", "lag", 1), ("p2_start", "lag", 2), ("p3_start", "lag", 3), ("p4_start", "lag", 4),
                  ("p1_plus_start", "lead", 1), ("p2_plus_start", "lead", 2), ("p3_plus_start", "lead", 3)]
    day = "strftime({0}, '%Y-%m-%d') as {1}"
    shifted = ", ".join(
        day.format(f"{f}(AM_StartDate, {n}) over (partition by AM_GC_COMPANY order by AM_StartDate)", name)
        for name, f, n in neighbours
    )
    add(
        "ageing_period_dates",
        scenario(lambda t, p, c: period_boundaries(t["AccPeriodManagement"]), params()),
        sql(
            f"select AM_GC_COMPANY, AM_PERIOD, {day.format('AM_EndDate', 'report_date')}, "
            f"{day.format('AM_StartDate', 'current_start')}, {day.format('AM_EndDate', 'current_end')}, {shifted} "
            "from AccPeriodManagement"
        ),
    )

    def in_period(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        posted = reported_headers(tables, p, ctx)
        return posted.groupBy("AH_TransactionType").agg(
            F.count(F.lit(1)).alias("transactions"), F.sum("AH_LocalTotal").alias("total")
        )

    add(
        "period_date_range",
        scenario(in_period, params(all_transactions=True, transaction_types=ALL_TYPES)),
        sql(
            "select AH_TransactionType, count(*) as transactions, cast(sum(AH_LocalTotal) as double) as total "
            "from AccTransactionHeader join AccPeriodManagement on AM_GC_COMPANY = AH_GC and AM_PERIOD = 199806 "
            "and cast(AH_PostDate as date) between cast(AM_StartDate as date) and cast(AM_EndDate as date) "
            "where AH_Ledger = 'AR' and AH_GC = 1 group by AH_TransactionType"
        ),
    )


def _filters() -> None:
    dates = "TransactionPK PostDate DueDate InvoiceDate InvoiceTotal"
    ranges = {
        "post_date_from": datetime(1997, 1, 1),
        "post_date_to": datetime(1997, 12, 31),
        "due_date_from": datetime(1997, 2, 1),
        "due_date_to": datetime(1997, 12, 31),
        "invoice_date_from": datetime(1997, 1, 15),
        "invoice_date_to": datetime(1997, 11, 30),
    }
    add_rows("date_range_filter", dates, listing(**ranges))
    add_rows("balance_use_outstanding", LIST_BASIC, listing(post_date_to=BLANK_DATE))
    whole = {"post_date_to": None, "ageing_dates": None}
    add_rows("listing_period", LIST_BASIC + " PostDate", listing(**whole, period=199806))
    add_rows("batch_inactive_only", LIST_BASIC, listing(include_active_batch=False))
    add_rows("not_in_batch_only", BASIC, params(not_in_active_batch_only=True))
    add_rows("ap_credit_rating_listing", LIST_BASIC, listing("AP", credit_ratings="R1"), rows(LIST_BASIC, ledger_amounts))
    add_rows("ap_credit_rating_ageing", BASIC, params("AP", credit_ratings="R1"), rows(BASIC, ledger_amounts))
    add_rows("list_param_filter", BASIC, params(accounts="C00000001, C00000005,C00000010,,C00000099"))
    add_rows("ledger_company_filter", BASIC, params("AP"), rows(BASIC, ledger_amounts))
    add_rows("transaction_type_filter", LIST_BASIC, listing(transaction_types=["CRD", "ADJ"]))
    add_rows(
        "multi_list_filter",
        BASIC + " BranchCode CountryCode AccountGroup ARCategory ConsolidationCategory CurrencyCode",
        params(
            branches="B00,B01,B03",
            countries="00,01,02,03,04,05,06,07,08,09,10,11,12",
            account_groups="DG0,DG1",
            relationships="K0,K1,K2",
            consolidation_categories="A0,A1",
            currencies=["USD", "EUR", "JPY", "KWD"],
        ),
    )
    add_rows("exclude_country_filter", BASIC + " CountryCode", params(excluded_countries="00,05,10,15,20"))
    add_rows("org_branch_filter", BASIC + " OrgBranchCode", params(org_branch="B02"))
    add_rows("settlement_group_filter", BASIC + " SettlementCode", params(settlement_groups="C00000000,C00000004,C00000007,C00000011"))
    add_rows("credit_rating_filter", BASIC, params(credit_ratings="R1"))
    add_rows("sales_rep_semi_join", BASIC, params(sales_rep="S07", sales_rep_roles="SAL,CRE"))
    add_rows("posted_to_gl_filter", BASIC, params(posted_to_gl="Y"))
    add_rows("collection_batch_filter", LIST_BASIC, listing(excluded_batch_types="DDB"))
    add_rows("collection_batch_filter_company", BASIC, params(excluded_batch_types="DDB"))
    add_rows("payment_method_filter", BASIC + " AgreedPaymentMethod", params(payment_methods="CHQ,Undefined"))
    add_rows("open_items_asof", BASIC + " BalanceInLocal DueDate PostDate CurrencyCode", params())
    for status, name in (("FUL", "full"), ("UNP", "unpaid"), ("PAR", "partial")):
        add_rows(f"payment_status_{name}", LIST_BASIC, listing(payment_status=status))
    amounts = rows(BASIC, ledger_amounts)
    add_rows("drop_zero_balance", BASIC, params(future_matches_apart=True, exclude_future_matches=True), amounts)
    charged = BASIC + " IsDSBInvoice DSBCharge"
    add_rows("disbursement_only", charged, params(disbursement_only=True), rows(charged, ledger_transactions))
    limits = BASIC + " SettlementGroupOverCreditLimit SettlementGroupCreditLimit SettlementGroupOutstandingAmount"
    add_rows("over_limit_only", limits, params(over_limit_only=True), rows(limits, base_transactions, frozenset({CREDIT})))
    p = params(overdue_only=True)
    due = rows(BASIC + " DueDate", lambda t, p, c: overdue(base_transactions(t, p, c), p))
    add_rows("overdue_only", BASIC + " DueDate", p, due, where="DueDate <= timestamp '1998-06-30 00:00:00'")
    add_rows("branch_management_filter", BASIC + " BranchCode", params(branch_management_code="G0", branches="B00,B02"))


def _projections() -> None:
    shared = (
        "TransactionPK AccountPK AccountCode AccountName BranchCode CountryCode CountryName TransactionType InvoiceRef "
        "Description InvoiceRef2 InvoiceTotal Balance BalanceInLocal DueDate InvoiceDate CurrencyPK CurrencyCode "
        "CreditLimit AccountGroup OrgBranchCode ExchangeRate IsDSBInvoice OSTotal ARCategory ConsolidationCategory "
        "SettlementCode SettlementName OrgBranchName TranBranchName RXSubUnitRatio PostDate AgreedPaymentMethod "
        "MatchStatus MatchStatusReason"
    )
    listed = shared + " TransactionTypeDesc DepartmentCode FullyPaidDate InvoiceTerm InvoiceExTax TaxAmount JobNumber"
    add_rows("base_all_ar", listed, listing())
    # Payables are compared before their signs are turned; only the SQL below turns none.
    for key, columns, p in (("base_all_ap", listed, listing("AP")), ("base_ageing_ap", shared, params("AP"))):
        names = columns.split()
        ctes = oracle.base_ctes(p)[0] + [
            "filled as (select * replace (case when coalesce(SettlementCode, '') = '' then AccountName else SettlementName end as SettlementName, "
            "case when coalesce(SettlementCode, '') = '' then AccountCode else SettlementCode end as SettlementCode) from paid)"
        ]
        text = oracle.query(ctes, f"select {', '.join(oracle.plain(c, KINDS[c]) for c in names)} from filled")
        add(key, scenario(rows(columns), p), text)
    add_rows("base_ageing_ar", shared, params())
    add_rows("transaction_type_desc", "TransactionPK TransactionType TransactionTypeDesc", listing())
    add_rows("balance_all_path", LIST_BASIC + " BalanceInLocal", listing(post_date_to=datetime(1996, 3, 31)))
    add_rows("balance_asof", "TransactionPK InvoiceTotal Balance BalanceInLocal", params())
    asof, listed = "TransactionPK InvoiceTotal Balance BalanceInLocal", LIST_BASIC + " BalanceInLocal"
    add_rows("balance_asof_snapshots", asof, params(), source=sample_with_snapshots)
    add_rows("balance_all_path_snapshots", listed, listing(post_date_to=datetime(1996, 3, 31)), source=sample_with_snapshots)
    add_rows("disbursement_flag", "TransactionPK IsDSBInvoice", params())
    add_rows("invoice_term_header", "TransactionPK TransactionType InvoiceTerm", listing())
    add_rows("invoice_term_best_match", "TransactionPK AccountCode InvoiceTerm", params(), terms("TransactionPK AccountCode InvoiceTerm"))
    p = params()
    add(
        "invoice_term_settlement",
        scenario(
            lambda t, p, c: terms("SettlementCode InvoiceTerm Balance")(t, p, c)
            .groupBy("SettlementCode", "InvoiceTerm")
            .agg(F.count(F.lit(1)).alias("transactions"), F.sum("Balance").alias("balance")),
            p,
        ),
        sql(
            "select SettlementCode, InvoiceTerm, count(*) as transactions, cast(sum(Balance) as double) as balance "
            "from w group by SettlementCode, InvoiceTerm",
            p,
        ),
    )
    signed = "TransactionPK Balance BalanceInLocal InvoiceTotal OSTotal InvoiceExTax TaxAmount"
    add_rows("ap_sign_flip", signed, listing("AP"), rows(signed, ledger_amounts))
    restated = "TransactionPK CurrencyCode ExchangeRate InvoiceTotal Balance BalanceInLocal MatchedInFuturePeriodInInvoiceCurrency"
    money = {"in_invoice_currency": True, "future_matches_apart": True}
    add_rows("restate_direct", restated, params(**money), rows(restated, ledger_amounts))
    add_rows("restate_reciprocal", restated, params(**money), rows(restated, ledger_amounts), reciprocal=True)
    whole = "TransactionPK CurrencyCode InvoiceTotal OSTotal Balance"
    add_rows("restate_full_amount", whole, listing(in_invoice_currency=True, payment_status="UNP"), rows(whole, ledger_amounts))
    charge = "TransactionPK IsDSBInvoice Balance DSBCharge"
    add_rows("disbursement_charge", charge, params(), rows(charge, ledger_transactions))
    add_rows("settlement_fill", "TransactionPK AccountCode SettlementCode SettlementName", params())
    status = "TransactionPK MatchStatus MatchStatusReason"
    add_rows("match_status_desc", status, listing(match_status_text=True), complete(status))
    add_rows("operator_initials", "TransactionPK OperatorInitials", params(show_operator=True), complete("TransactionPK OperatorInitials"))
    value = "TransactionPK PeriodEndRate RevaluedLocalEquivalent GainLossOnRevaluation GainOnRevaluation LossOnRevaluation"
    p = params("AP", in_invoice_currency=True)
    add("revaluation_gain_loss", scenario(revalued_rows(value), p), select_revalued(p, ["TransactionPK"]))
    p = params(in_invoice_currency=True)
    rated = "TransactionPK CurrencyCode PeriodEndRate RevaluedLocalEquivalent GainLossOnRevaluation GainOnRevaluation LossOnRevaluation"
    add("exchange_rate_asof", scenario(revalued_rows(rated), p, True), select_revalued(p, ["TransactionPK", "CurrencyCode"], True))
    future = BASIC + " MatchedInFuturePeriodInLocalCurrency MatchedInFuturePeriodInInvoiceCurrency"
    stage = rows(future, ledger_amounts)
    add_rows("future_match_amount", future, params(future_matches_apart=True), stage)
    add_rows("future_match_exclude", future, params(future_matches_apart=True, exclude_future_matches=True), stage)
    add_rows("future_match_include", future, params(future_matches_apart=True, current_date_time=REPORT_DAY), stage)


def _ageing() -> None:
    def buckets(local: bool = False) -> str:
        names = list(BUCKETS) + ([n + LOCAL_SUFFIX for n in BUCKETS] if local else [])
        return "TransactionPK Balance " + " ".join(names)

    def aged(key: str, local: bool = False, **more) -> None:
        columns = buckets(local)
        add_rows(key, columns, params(local_equivalent=local, **more), rows(columns, ledger_transactions))

    aged("ageing_due", aged_by="DUE")
    aged("ageing_due_local", local=True, aged_by="DUE", in_invoice_currency=True)
    days = {"ageing_option": "DAY", "day1": 30, "day2": 60, "day3": 90, "day4": 120}
    for code, name in (("PST", "post"), ("INV", "invoice")):
        aged(f"ageing_{name}_period", aged_by=code)
        aged(f"ageing_{name}_days", aged_by=code, **days)
    aged("ageing_due_days", aged_by="DUE", **days)
    aged("ageing_none", aged_by="NON")


def _accounts() -> None:
    ar, ap = params(), params("AP")

    def base(columns: dict[str, str]) -> Build:
        return lambda t, p, c: account_base(t, p).select(*[F.col(k).alias(v) for k, v in columns.items()])

    def accounts(select: str) -> str:
        return oracle.query([oracle.account_cte(ar)], f"select {select} from accounts")

    add(
        "account_country",
        scenario(base({"OH_PK": "org", "OH_Code": "code", "RN_Code": "country", "RN_Desc": "name"}), ar),
        accounts("org, code, land as country, land_name as name"),
    )
    add(
        "account_company_data",
        scenario(
            lambda t, p, c: account_profile(t, p, c, BASE_PARTS).select(
                F.col("AccountPK").alias("org"), "CreditLimit", "OrgBranchCode", "OrgBranchName", "AccountGroup", "ARCategory",
                "ConsolidationCategory",
            ),
            ar,
        ),
        accounts(
            f"org, cast({oracle.limit_sql(ar)} as double) as CreditLimit, home as OrgBranchCode, home_name as OrgBranchName, "
            "grp as AccountGroup, OB_ARCategory as ARCategory, OB_ARConsolidatedAccountingCategory as ConsolidationCategory"
        ),
    )
    add(
        "settlement_party",
        scenario(base({"OH_PK": "org", "SettlementPK": "settling", "PartyCode": "code", "PartyName": "name"}), ar),
        accounts("org, settling, settling_code as code, settling_name as name"),
    )
    roles = ", ".join(
        f"max(case when O8_Role = '{r}' then {c} end) as {n}{s}"
        for r, n in contacts.STAFF_ROLES.items()
        for c, s in (("code", ""), ("name", "Name"))
    )
    add(
        "assigned_staff",
        scenario(lambda t, p, c: contacts.assigned_staff(t, p), ar),
        oracle.query(
            oracle.contact_ctes(ar),
            f"select a.O8_OH, {roles.replace('O8_Role', 's.O8_Role')} from (select distinct O8_OH from StaffAssignments "
            "where O8_Department = 'ALL' and O8_Role in ('SAL', 'CRE', 'CUS')) a left join staffed s on s.O8_OH = a.O8_OH group by a.O8_OH",
        ),
    )

    def ranked(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
        staff = contacts.assigned_staff(tables, p)
        pairs = [F.struct(F.lit(r).alias("role"), F.col(n).alias("code")) for r, n in contacts.STAFF_ROLES.items()]
        return staff.select("O8_OH", F.inline(F.array(*pairs))).filter(F.col("code").isNotNull())

    add(
        "assigned_staff_rank",
        scenario(ranked, ar),
        oracle.query(oracle.contact_ctes(ar), "select O8_OH, O8_Role as role, code from staffed"),
    )
    add(
        "additional_company_name",
        scenario(lambda t, p, c: contacts.additional_company_names(t, p), ar),
        sql("select CN_OH, CompanyName as AdditionalCompanyName from CompanyNames"),
    )
    for ledger, p in (("ar", ar), ("ap", ap)):
        add(
            f"primary_contact_{ledger}",
            scenario(lambda t, p, c: contacts.primary_contacts(t, p).select("OC_OH", "ContactName"), p),
            oracle.query(oracle.contact_ctes(p), "select OC_OH, OC_ContactName as ContactName from chosen"),
        )
    add(
        "contact_address_override",
        scenario(lambda t, p, c: contacts.primary_contacts(t, p).select("OC_OH", "OC_OH_AddressOverride"), ar),
        oracle.query(oracle.contact_ctes(ar), "select OC_OH, OC_OH_AddressOverride from reached"),
    )
    add(
        "main_office_phone",
        scenario(
            lambda t, p, c: contacts.office_phones(t, p, c).filter("sole").select("office_org", "phone"), ar
        ),
        oracle.query(oracle.contact_ctes(ar), "select OA_OH as office_org, OA_Phone as phone from sole"),
    )
    for scope, key in (("global", "country_office_phone"), ("per_org", "country_office_phone_per_org")):
        p = params(country_office_scope=scope)
        add(
            key,
            scenario(
                lambda t, p, c: contacts.office_phones(t, p, c).filter("at_home").select("office_org", "home_phone"), p
            ),
            oracle.query(oracle.contact_ctes(p), "select OA_OH as office_org, OA_Phone as home_phone from home"),
        )

    def reached(columns: str) -> Build:
        names = columns.split()
        return lambda t, p, c: contacts.with_contacts(
            t["OrgHeader"].select(F.col("OH_PK").alias("AccountPK")), t, p, c
        ).select("AccountPK", *names)

    p = params("AP", country_office_scope="per_org")
    add(
        "contact_phone",
        scenario(reached("ContactName ContactPhoneNo"), p),
        oracle.query(oracle.contact_ctes(p), "select OH_PK as AccountPK, ContactName, ContactPhoneNo from contacted"),
    )
    add(
        "contact_info",
        scenario(reached("ContactInfo"), ar),
        oracle.query(
            oracle.contact_ctes(ar),
            f"select OH_PK as AccountPK, coalesce(ContactName, '{NO_CONTACT}') || ' (Ph:' || ContactPhoneNo || ')' as ContactInfo from contacted",
        ),
    )

    def credit_columns(columns: str) -> Build:
        return lambda t, p, c: account_profile(t, p, c, frozenset({CREDIT})).select("AccountPK", *columns.split())

    # An account is listed once for each account that settles for it.
    settled = (
        "from OrgHeader o left join OrgRelatedParty on PR_OH_Parent = o.OH_PK and PR_GC = 1 and PR_PartyType = '{party}' "
        "left join settled s on s.OH_PK = o.OH_PK"
    )
    add(
        "settlement_usage_flag",
        scenario(credit_columns("ARUseSettlementGroupCreditLimit UsingOrgAsOwnSettlementGroup"), ar),
        oracle.query(
            oracle.settlement_ctes(ar),
            f"select o.OH_PK as AccountPK, s.flag as ARUseSettlementGroupCreditLimit, s.own as UsingOrgAsOwnSettlementGroup {settled.format(party='ARS')}",
        ),
    )
    for key, p in (("settlement_over_limit", ar), ("settlement_over_limit_ap", ap)):
        add(
            key,
            scenario(
                credit_columns("SettlementGroupCreditLimit SettlementGroupOutstandingAmount SettlementGroupOverCreditLimit"), p
            ),
            oracle.query(
                oracle.settlement_ctes(p),
                "select o.OH_PK as AccountPK, cast(s.lim as double) as SettlementGroupCreditLimit, "
                "cast(s.owed as double) as SettlementGroupOutstandingAmount, "
                f"case when s.owed > s.lim then 'Y' else 'N' end as SettlementGroupOverCreditLimit {settled.format(party=p.party_type)}",
            ),
        )
    add(
        "settlement_exposure_group",
        scenario(lambda t, p, c: credit.exposure_in_groups(t, p), ar),
        oracle.query(
            oracle.settlement_ctes(ar), "select account, cast(owed as double) as exposure from in_group"
        ),
    )
    add(
        "settlement_exposure_own",
        scenario(lambda t, p, c: credit.exposure_as_head(t, p), ar),
        oracle.query(
            oracle.settlement_ctes(ar),
            "select account, cast(owed as double) as exposure from as_head "
            "where account in (select head from grouped) or account in (select AH_OH from owing)",
        ),
    )


def _sums() -> None:
    add(
        "matched_amount",
        scenario(
            lambda t, p, c: matching.matched_amount(
                t["AccTransactionMatchLink"], F.col("AP_MatchDate") > F.lit("1998-06-30").cast("timestamp_ntz")
            ),
            params(),
        ),
        sql(
            "select AP_AH, cast(sum(AP_Amount) as double) as matched from AccTransactionMatchLink "
            "where AP_MatchDate > timestamp '1998-06-30 00:00:00' group by AP_AH"
        ),
    )
    mark = "TransactionPK AccountCode CreditLimit Balance IsOverLimit"
    add_rows("credit_over_limit_mark", mark, params(in_invoice_currency=True), complete(mark))
    lines = "TransactionPK TransactionType LineInvoiceExTaxAmount LineTaxAmount"
    add_rows("line_amounts", lines, listing(line_amounts=True), rows(lines, ledger_transactions))

    for key, label, ledger in (
        ("transaction_type", "Transaction Type", "AR"),
        ("consolidation_category", "Consolidation Category", "AR"),
        ("accounts_relationship", "Accounts Relationship", "AR"),
        ("org_branch", "Organisation Branch", "AR"),
        ("transaction_branch", "Transaction Branch", "AR"),
        ("sales_rep", "Sales Rep", "AR"),
        ("credit_controller", "Credit Controller", "AR"),
        ("customer_service", "Customer Service Rep", "AR"),
        ("settlement_group", "Settlement Group", "AR"),
        ("account_group", "Debtor Group", "AR"),
        ("creditor_group", "Creditor Group", "AP"),
    ):
        p = listing(ledger, summary_only=True, group_by=label, line_amounts=True, in_invoice_currency=key == "sales_rep")
        add(f"summary_{key}", scenario(report, p), select_listing_summary(p))

    # A column that is null throughout has no type to compare, so it is left out.
    def summary(p: ReportParams, columns: list[str] | None = None, reciprocal: bool = False):
        sql_text = select_ageing_summary(p, columns, reciprocal)
        absent = [] if p.in_invoice_currency else ["CurrencyPK"]

        def build(tables: Tables, params: ReportParams, ctx: RunContext) -> DataFrame:
            df = run_report(tables, params)
            return df.select(*columns) if columns else df.drop(*absent)

        return scenario(build, p, reciprocal, {"AverageExchangeRate": 6}), sql_text

    add("ageing_summary", *summary(params(summary_only=True, local_equivalent=True)))
    add(
        "ageing_summary_branch",
        *summary(params("AP", summary_only=True, group_by="Transaction Currency, Transaction Branch then Organisation")),
    )
    add(
        "ageing_summary_currency",
        *summary(params(summary_only=True, in_invoice_currency=True, disbursement_only=True, overdue_only=True)),
    )
    later = {"future_matches_apart": True, "exclude_future_matches": True}
    add("ageing_summary_later_matches", *summary(params(summary_only=True, local_equivalent=True, **later)))
    names = ["AccountCode", "SettlementCode", "IsOverLimit", "Balance", "InvoiceTerm"]
    add("distinct_terms_agg", *summary(params(summary_only=True), names))
    names = ["AccountCode", "SettlementCode", "CurrencyCode", "Balance", "BalanceInLocal", "AverageExchangeRate"]
    add("average_exchange_rate", *summary(params(summary_only=True, in_invoice_currency=True), names, True))


def _details() -> None:
    for key, order in (
        ("detail_post_date", ORDER_BY_POST_DATE),
        ("detail_invoice_date", ORDER_BY_INVOICE_DATE),
        ("detail_type_number", ORDER_BY_TYPE),
        ("detail_number_type", ORDER_BY_NUMBER),
    ):
        p = listing(order_by=order, line_amounts=True, show_operator=True, match_status_text=key == "detail_post_date",
                    overdue_only=key == "detail_number_type", legacy_invoice_sort=key == "detail_invoice_date")
        where = "DueDate <= timestamp '1998-06-30 00:00:00'" if p.overdue_only else "true"
        add(key, scenario(detail, p), select_working(p, None, False, where))
    p = params("AP", order_by=ORDER_BY_TRANSACTION, overdue_only=True, local_equivalent=True)
    add("detail_trn", scenario(detail, p), select_working(p))
    p = params(in_invoice_currency=True, show_operator=True, local_equivalent=True)

    def revalued(tables: Tables, params: ReportParams, ctx: RunContext) -> DataFrame:
        return run_report(tables, params).select(*KINDS, "PeriodEndRate", *oracle.REVALUED)

    add("revaluation_detail", scenario(revalued, p), select_revalued(p))


for part in (_lookups, _filters, _projections, _ageing, _accounts, _sums, _details):
    part()
