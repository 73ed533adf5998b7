"""Account attributes, resolved once per account rather than per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import in_list, join_sparse
from duebook.operators.contacts import accounts_of_sales_rep, additional_company_names, assigned_staff, with_contacts
from duebook.operators.credit import company_data, credit_limit, settlement_parties, with_settlement_credit
from duebook.operators.terms import credit_term
from duebook.params import ReportParams
from duebook.plans.context import RunContext
from duebook.sources.tables import Tables

# Parts of the profile a report can ask for; each costs the joins it needs.
COUNTRY, COMPANY, SETTLEMENT = "country", "company", "settlement"
STAFF, COMPANY_NAME, CONTACT, CREDIT = "staff", "company_name", "contact", "credit"
BASE_PARTS = frozenset((COUNTRY, COMPANY, SETTLEMENT))
ALL_PARTS = BASE_PARTS | {STAFF, COMPANY_NAME, CONTACT, CREDIT}

# Report columns every profile has, and those each part brings.
PROFILE_COLUMNS = (
    "AccountPK",
    "SettlementPK",
    "AccountCode",
    "AccountName",
    "CreditLimit",
    "ARCategory",
    "ConsolidationCategory",
    "AccountTerm",
)
PART_COLUMNS = {
    COUNTRY: ("CountryCode", "CountryName"),
    COMPANY: ("OrgBranchCode", "OrgBranchName", "AccountGroup"),
    SETTLEMENT: ("SettlementCode", "SettlementName"),
    STAFF: (
        "SalesRep",
        "SalesRepName",
        "CreditController",
        "CreditControllerName",
        "CustomerService",
        "CustomerServiceName",
    ),
    COMPANY_NAME: ("AdditionalCompanyName",),
    CONTACT: ("ContactInfo", "ContactName", "ContactPhoneNo", "OC_OH_AddressOverride"),
    CREDIT: (
        "ARUseSettlementGroupCreditLimit",
        "SettlementGroupCreditLimit",
        "SettlementGroupOutstandingAmount",
        "SettlementGroupOverCreditLimit",
        "UsingOrgAsOwnSettlementGroup",
    ),
}


def with_country(orgs: DataFrame, tables: Tables) -> DataFrame:
    """Country of each org through its closest port."""
    ports = tables["RefUNLOCO"]
    countries = tables["RefCountry"]
    return (
        orgs.join(ports, F.col("OH_RL_NKClosestPort") == F.col("RL_Code"), "left")
        .join(countries, F.col("RL_RN_NKCountryCode") == F.col("RN_Code"), "left")
        .drop("RL_Code", "RL_RN_NKCountryCode")
    )


def with_company_data(orgs: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The company's data of each org."""
    data = company_data(tables, p).withColumn("has_company_data", F.lit(True))
    return orgs.join(data, F.col("OH_PK") == F.col("OB_OH"), "left")


def with_branch_and_group(orgs: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Controlling branch of each org, and its debtor or creditor group."""
    branches = tables["GlbBranch"].select(
        F.col("GB_PK").alias("org_branch"),
        F.col("GB_Code").alias("OrgBranchCode"),
        F.col("GB_BranchName").alias("OrgBranchName"),
    )
    table, key, code, group = (
        ("OrgDebtorGroup", "OJ_PK", "OJ_Code", "OB_OJ_ARDebtorGroup")
        if p.is_ar
        else ("OrgCreditorGroup", "OG_PK", "OG_Code", "OB_OG_APCreditorGroup")
    )
    groups = tables[table].select(F.col(key).alias("org_group"), F.col(code).alias("AccountGroup"))
    return orgs.join(branches, F.col("OB_GB_ControllingBranch") == F.col("org_branch"), "left").join(
        groups, F.col(group) == F.col("org_group"), "left"
    )


def with_settlement_party(orgs: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """The account that settles for each org. Several of them repeat the org."""
    parties = settlement_parties(tables, p).withColumnRenamed("PR_OH_RelatedParty", "SettlementPK")
    return orgs.join(parties, F.col("OH_PK") == F.col("PR_OH_Parent"), "left").drop("PR_OH_Parent")


def with_party_name(orgs: DataFrame, tables: Tables) -> DataFrame:
    """Code and name of the settling account. One that does not exist has no key either."""
    settling = tables["OrgHeader"].select(
        F.col("OH_PK").alias("party"),
        F.col("OH_PK").alias("known_party"),
        F.col("OH_Code").alias("PartyCode"),
        F.col("OH_FullName").alias("PartyName"),
    )
    named = join_sparse(orgs, settling, "SettlementPK", "party", "OH_PK")
    return named.withColumn("SettlementPK", F.col("known_party")).drop("known_party")


def has_account_filter(p: ReportParams) -> bool:
    """Whether some filter drops transactions without an account."""
    lists = (
        p.accounts,
        p.account_groups,
        p.countries,
        p.settlement_groups,
        p.relationships,
        p.consolidation_categories,
    )
    rated = p.credit_ratings is not None and (p.is_ar or p.all_transactions)
    excluding = bool(p.excluded_countries)
    return any(v is not None for v in lists) or excluding or rated or bool(p.org_branch) or bool(p.sales_rep) or bool(p.over_limit_only)


def filter_accounts(df: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Apply the filters on account attributes, before accounts meet transactions."""
    category = "OB_ARCategory" if p.is_ar else "OB_APCategory"
    tests = [
        (F.col("OH_Code"), p.accounts),
        (F.col("RN_Code"), p.countries),
        (F.col("AccountGroup"), p.account_groups),
        (F.col(category), p.relationships),
        (F.col("OB_ARConsolidatedAccountingCategory"), p.consolidation_categories),
        (F.coalesce("PartyCode", "OH_Code"), p.settlement_groups),
    ]
    # The payables ageing does not look at credit ratings; elsewhere it is the receivables rating.
    if p.is_ar or p.all_transactions:
        tests.append((F.col("OB_ARCreditRating"), p.credit_ratings))
    for column, values in tests:
        if values is not None:
            df = df.filter(in_list(column, values))
    if p.excluded_countries:
        # An unknown country is excluded too.
        df = df.filter(~F.col("RN_Code").isin(list(p.excluded_countries)))
    if p.org_branch:
        df = df.filter(F.col("OrgBranchCode") == p.org_branch)
    if p.sales_rep:
        df = df.join(accounts_of_sales_rep(tables, p), F.col("OH_PK") == F.col("O8_OH"), "left_semi")
    return df


def account_base(
    tables: Tables, p: ReportParams, parts: frozenset[str] = BASE_PARTS
) -> DataFrame:
    """Filtered accounts, one row per settling account, with what the parts or the filters need."""
    df = with_settlement_party(with_company_data(tables["OrgHeader"], tables, p), tables, p)
    if COUNTRY in parts or p.countries is not None or p.excluded_countries:
        df = with_country(df, tables)
    if COMPANY in parts or p.account_groups is not None or p.org_branch:
        df = with_branch_and_group(df, tables, p)
    if SETTLEMENT in parts or p.settlement_groups is not None:
        df = with_party_name(df, tables)
    return filter_accounts(df, tables, p)


def account_profile(
    tables: Tables, p: ReportParams, ctx: RunContext, parts: frozenset[str] = ALL_PARTS
) -> DataFrame:
    """Accounts with the attributes a report shows, and no others.

    A blank settlement group is filled from the account itself, code and name. Accounts
    within their limit are left out, where only the others are wanted, if credit is shown.
    """
    term = (
        credit_term(F.col("OB_ARCreditApproved"), F.col("OB_AROnCreditHold"))
        if p.is_ar and not p.all_transactions
        else F.lit(None).cast("string")
    )
    columns = {
        "AccountPK": F.col("OH_PK"),
        "AccountCode": F.col("OH_Code"),
        "AccountName": F.col("OH_FullName"),
        "CreditLimit": credit_limit(p),
        "ARCategory": F.col("OB_ARCategory" if p.is_ar else "OB_APCategory"),
        "ConsolidationCategory": F.col("OB_ARConsolidatedAccountingCategory"),
        "AccountTerm": term,
    }
    if COUNTRY in parts:
        columns |= {"CountryCode": F.col("RN_Code"), "CountryName": F.col("RN_Desc")}
    if SETTLEMENT in parts:
        unsettled = F.coalesce(F.col("PartyCode"), F.lit("")) == ""
        columns |= {
            "SettlementCode": F.when(unsettled, F.col("OH_Code")).otherwise(F.col("PartyCode")),
            "SettlementName": F.when(unsettled, F.col("OH_FullName")).otherwise(F.col("PartyName")),
        }
    df = account_base(tables, p, parts).withColumns(columns)
    if CREDIT in parts:
        df = with_settlement_credit(df, tables, p)
        if p.over_limit_only:
            df = df.filter(F.col("SettlementGroupOverCreditLimit") == "Y")
    if STAFF in parts:
        df = df.join(assigned_staff(tables, p), F.col("AccountPK") == F.col("O8_OH"), "left")
    if COMPANY_NAME in parts:
        df = df.join(additional_company_names(tables, p), F.col("AccountPK") == F.col("CN_OH"), "left")
    if CONTACT in parts:
        df = with_contacts(df, tables, p, ctx)
    return df.select(*PROFILE_COLUMNS, *[c for part in sorted(parts) for c in PART_COLUMNS[part]])
