"""Staff, contacts and phone numbers, one row per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import first_row, join_sparse
from duebook.params import ReportParams
from duebook.plans.context import RunContext
from duebook.sources.tables import Tables, of_company

# Staff roles and the report columns they fill.
STAFF_ROLES = {"SAL": "SalesRep", "CRE": "CreditController", "CUS": "CustomerService"}
ALL_DEPARTMENTS = "ALL"
# Document groups of receivables and payables contacts, office type, text without contact.
DOCUMENT_GROUPS = {"AR": ("A/R", "ALL"), "AP": ("A/P", "ALL")}
OFFICE = "OFC"
NO_CONTACT = "No Contact Available"


def assignments(tables: Tables, p: ReportParams) -> DataFrame:
    staff = of_company(tables["StaffAssignments"], "O8_GC", p.company)
    return staff.filter(F.col("O8_Department") == ALL_DEPARTMENTS)


def accounts_of_sales_rep(tables: Tables, p: ReportParams) -> DataFrame:
    """Accounts looked after by one staff member, in any of the given roles."""
    rows = assignments(tables, p).filter(F.col("O8_GS_NKPersonResponsible") == p.sales_rep)
    if p.sales_rep_roles is not None:
        rows = rows.filter(F.col("O8_Role").isin(list(p.sales_rep_roles)))
    known = tables["GlbStaff"].select("GS_Code")
    return rows.join(known, F.col("GS_Code") == F.col("O8_GS_NKPersonResponsible"), "left_semi").select("O8_OH")


def assigned_staff(tables: Tables, p: ReportParams) -> DataFrame:
    """First staff code per account and role, with the name.

    The first is chosen before looking at the staff table: if that lacks it, the role
    stays empty. One grouping by account serves all roles.
    """
    code = F.col("O8_GS_NKPersonResponsible")
    firsts = (
        assignments(tables, p)
        .filter(F.col("O8_Role").isin(*STAFF_ROLES))
        .groupBy("O8_OH")
        .agg(
            *[
                first_row([code], [code.alias("code")], F.col("O8_Role") == role)["row"]["code"].alias(f"first_{name}")
                for role, name in STAFF_ROLES.items()
            ]
        )
    )
    for name in STAFF_ROLES.values():
        known = tables["GlbStaff"].select(F.col("GS_Code").alias(name), F.col("GS_FullName").alias(f"{name}Name"))
        firsts = firsts.join(known, F.col(f"first_{name}") == F.col(name), "left")
    return firsts.select("O8_OH", *[c for name in STAFF_ROLES.values() for c in (name, f"{name}Name")])


def contact_names(tables: Tables, p: ReportParams) -> DataFrame:
    """Contacts by account and name, with their best rank, address override and own phone.

    The rank is that of the best document of the ledger; it is null if there is none.
    Of several contacts of one name the lowest key gives override and phone.
    """
    groups = DOCUMENT_GROUPS[p.ledger]
    default_first = F.coalesce(-F.col("OD_DefaultContact"), F.lit(1))
    documents = (
        tables["OrgDocument"]
        .filter(F.col("OD_DocumentGroup").isin(*groups))
        .groupBy("OD_OC")
        .agg(F.min(F.struct("OD_DocumentGroup", default_first.alias("default_first"))).alias("document"))
    )
    override = F.col("OC_OH_AddressOverride")
    usable = (F.col("OC_IsActive") == 1) & F.col("document").isNotNull()
    aggregates = [
        F.min(F.when(usable, F.col("document"))).alias("rank"),
        first_row([F.col("OC_PK")], [override])["row"]["OC_OH_AddressOverride"].alias("override"),
        first_row([F.col("OC_PK")], [F.col("OC_Phone")], override.isNull())["row"]["OC_Phone"].alias("phone"),
        F.count(F.lit(1)).alias("same_name"),
    ]
    return (
        tables["OrgContact"]
        .join(documents, F.col("OC_PK") == F.col("OD_OC"), "left")
        .groupBy("OC_OH", "OC_ContactName")
        .agg(*aggregates)
    )


def primary_contacts(tables: Tables, p: ReportParams) -> DataFrame:
    """The contact of each account: by document group, default flag and name."""
    name = F.col("OC_ContactName")
    columns = [name, F.col("override"), F.col("phone"), F.col("same_name")]
    best = (
        contact_names(tables, p)
        .groupBy("OC_OH")
        .agg(first_row([F.col("rank"), name], columns, F.col("rank").isNotNull())["row"].alias("best"))
        .filter(F.col("best").isNotNull())
    )
    named = F.col("best.OC_ContactName").isNotNull()
    override = F.when(named, F.col("best.override"))
    if p.strict_contacts:
        twice = F.raise_error(F.lit("several contacts share the name of an account's contact"))
        override = F.when(named & (F.col("best.same_name") > 1), twice).otherwise(override)
    return best.select(
        "OC_OH",
        F.col("best.OC_ContactName").alias("ContactName"),
        override.alias("OC_OH_AddressOverride"),
        F.when(named, F.col("best.phone")).alias("own_phone"),
    )


def main_offices(tables: Tables) -> DataFrame:
    """Addresses that are a main office."""
    capability = tables["OrgAddressCapability"].filter(
        (F.col("PZ_IsMainAddress") == 1) & (F.col("PZ_AddressType") == OFFICE)
    )
    return tables["OrgAddress"].join(capability.select("PZ_OA"), F.col("OA_PK") == F.col("PZ_OA"))


def office_phones(tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Per account with a main office: the phone of a sole one, and that of one in the company's country.

    A country office counts if it is the account's first, or if it is the first of all
    accounts, depending on the scope.
    """
    offices = main_offices(tables)
    at_home = F.substring("OA_RL_NKRelatedPortCode", 1, 2) == F.lit(ctx.country_code)
    first = first_row([F.col("OA_PK")], [F.col("OA_PK"), F.col("OA_Phone")], at_home)["row"]
    per_org = offices.groupBy("OA_OH").agg(
        F.max("OA_Phone").alias("phone"), F.count(F.lit(1)).alias("offices"), first.alias("home")
    )
    home = F.col("home").isNotNull()
    if p.country_office_scope == "global":
        home = home & (F.col("home.OA_PK") == offices.filter(at_home).agg(F.min("OA_PK")).scalar())
    return per_org.select(
        F.col("OA_OH").alias("office_org"),
        (F.col("offices") == 1).alias("sole"),
        "phone",
        F.coalesce(home, F.lit(False)).alias("at_home"),
        F.col("home.OA_Phone").alias("home_phone"),
    )


def with_contacts(accounts: DataFrame, tables: Tables, p: ReportParams, ctx: RunContext) -> DataFrame:
    """Add the contact's name, phone and text to accounts.

    A contact with an address override is reached through the override's main office, or
    better through its office in the company's country. If that leaves no number, the
    account's own offices are tried in the same way, first come first served.
    """
    offices = office_phones(tables, p, ctx)
    of_override = offices.select(*[F.col(c).alias(f"over_{c}") for c in offices.columns])
    df = accounts.join(primary_contacts(tables, p), F.col("AccountPK") == F.col("OC_OH"), "left")
    df = df.join(offices, F.col("AccountPK") == F.col("office_org"), "left")
    df = join_sparse(df, of_override, "OC_OH_AddressOverride", "over_office_org", "AccountPK")

    def if_blank(phone: Column, found: str, other: str) -> Column:
        blank = phone.isNull() | (phone == "")
        return F.when(blank & F.col(found), F.col(other)).otherwise(phone)

    by_contact = (
        F.when(F.col("OC_OH_AddressOverride").isNull(), F.col("own_phone"))
        .when(F.col("over_at_home"), F.col("over_home_phone"))
        .when(F.col("over_sole"), F.col("over_phone"))
    )
    df = df.withColumn("ContactPhoneNo", by_contact)
    df = df.withColumn("ContactPhoneNo", if_blank(F.col("ContactPhoneNo"), "sole", "phone"))
    df = df.withColumn("ContactPhoneNo", if_blank(F.col("ContactPhoneNo"), "at_home", "home_phone"))
    name = F.coalesce(F.col("ContactName"), F.lit(NO_CONTACT))
    text = F.concat(name, F.lit(" (Ph:"), F.col("ContactPhoneNo"), F.lit(")"))
    return df.select(
        *accounts.columns, "ContactName", "ContactPhoneNo", "OC_OH_AddressOverride", text.alias("ContactInfo")
    )


def additional_company_names(tables: Tables, p: ReportParams) -> DataFrame:
    """The other company name of accounts, for the branch if there is one for it."""
    names = of_company(tables["CompanyNames"], "CN_GC", p.company)
    order = [F.col("CompanyName")]
    if "CN_Ledger" in names.columns:
        names = names.filter(F.col("CN_Ledger").isNull() | (F.col("CN_Ledger") == p.ledger))
        order.insert(0, F.col("CN_Ledger").isNull())
    if "CN_GB" in names.columns:
        names = names.filter(F.col("CN_GB").isNull() | (F.col("CN_GB") == F.lit(p.branch)))
        order.insert(0, F.col("CN_GB").isNull())
    chosen = first_row(order, [F.col("CompanyName")])["row"]["CompanyName"]
    return names.groupBy("CN_OH").agg(chosen.alias("AdditionalCompanyName"))
