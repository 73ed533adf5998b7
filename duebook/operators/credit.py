"""Settlement groups: who pays for whom, exposure and credit limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import adjusted_credit_limit, first_row
from duebook.operators.headers import NOT_BALANCED_TYPE, of_ledger
from duebook.params import ReportParams
from duebook.sources.tables import Tables

#: Heads up to which an account's or member's amounts go by subsets of its heads, which are up to 2 ** FEW_HEADS.
FEW_HEADS = 6


def company_data(tables: Tables, p: ReportParams) -> DataFrame:
    return tables["OrgCompanyData"].filter(F.col("OB_GC") == F.lit(p.company))


def credit_limit(p: ReportParams) -> Column:
    """Limit of an account in the ledger. Only receivables know a temporary increase."""
    if not p.is_ar:
        return F.col("OB_APCreditLimit")
    return adjusted_credit_limit(
        F.col("OB_ARCreditLimit"),
        F.col("OB_ARTemporaryCreditLimitIncrease"),
        F.col("OB_ARTemporaryCreditLimitIncreaseExpiry"),
        p.today,
    )


def settlement_parties(tables: Tables, p: ReportParams) -> DataFrame:
    """Accounts and the account that settles for them."""
    return (
        tables["OrgRelatedParty"]
        .filter((F.col("PR_GC") == F.lit(p.company)) & (F.col("PR_PartyType") == p.party_type))
        .select("PR_OH_Parent", "PR_OH_RelatedParty")
    )


def settling_accounts(tables: Tables, p: ReportParams) -> DataFrame:
    """Distinct (PR_OH_Parent, SettlementPK) of accounts that exist; the key is null where the settling one does not."""
    accounts = tables["OrgHeader"].select("OH_PK")
    parties = settlement_parties(tables, p).join(accounts, F.col("PR_OH_Parent") == F.col("OH_PK"), "left_semi")
    known = accounts.withColumnRenamed("OH_PK", "SettlementPK")
    return (
        parties.join(known, F.col("PR_OH_RelatedParty") == F.col("SettlementPK"), "left")
        .select("PR_OH_Parent", "SettlementPK")
        .distinct()
    )


def group_members(tables: Tables, p: ReportParams) -> DataFrame:
    """Distinct (settling account, account) pairs of accounts that use their group's limit.

    Company data counts whatever its company, and its receivables flag serves both ledgers.
    """
    users = tables["OrgCompanyData"].filter(F.col("OB_ARUseSettlementGroupCreditLimit") == 1).select("OB_OH")
    return (
        settlement_parties(tables, p)
        .join(users, F.col("PR_OH_Parent") == F.col("OB_OH"), "left_semi")
        .select(F.col("PR_OH_RelatedParty").alias("head"), F.col("PR_OH_Parent").alias("member"))
        .distinct()
    )


def outstanding_by_account(tables: Tables, p: ReportParams) -> DataFrame:
    """What each account owes now, whatever the report date.

    All that use it want accounts, so transactions without one go here, and one scan serves all.
    """
    return (
        of_ledger(tables["AccTransactionHeader"], p)
        .filter((F.col("AH_TransactionType") != NOT_BALANCED_TYPE) & F.col("AH_OH").isNotNull())
        .groupBy(F.col("AH_OH").alias("org"))
        .agg(F.sum("AH_OutstandingAmount").alias("owed"))
    )


@dataclass(frozen=True)
class Groups:
    """What exposure is worked out from, built once for a report."""

    #: (head, member): distinct settling accounts and the accounts that use their limit.
    members: DataFrame
    #: (org, owed): what each account owes now.
    owed: DataFrame

    @property
    def sets(self) -> DataFrame:
        """Distinct members of each group, its head among them."""
        return self.members.select("head", F.explode(F.array("member", "head")).alias("member")).distinct()


def settlement_groups(tables: Tables, p: ReportParams) -> Groups:
    return Groups(group_members(tables, p), outstanding_by_account(tables, p))


def subsets(heads: Column) -> Column:
    """All subsets of a few heads, in the heads' order, but for the empty one."""
    nothing = F.array(F.array().cast("array<string>"))
    every = F.aggregate(heads, nothing, lambda found, head: F.concat(found, F.transform(found, lambda s: F.array_append(s, head))))
    return F.filter(every, lambda s: F.size(s) > 0)


def spelled_heads() -> Column:
    """The heads of a group of rows, as text in one order."""
    return F.array_sort(F.collect_set(F.col("head").cast("string")))


def members_by_heads(groups: Groups) -> DataFrame:
    """(member, heads, owed) of the members that owe anything, with all heads they stand under."""
    weighted = groups.sets.join(groups.owed.filter(F.col("owed").isNotNull()), F.col("member") == F.col("org"))
    return weighted.groupBy("member").agg(spelled_heads().alias("heads"), F.first("owed").alias("owed"))


def common_sums(members: DataFrame) -> DataFrame:
    """(common, total, owing): what is owed by the members that stand under all of some heads, and by how many.

    Each member adds its amount to the subsets of its own heads, so rows grow with the members, however many different
    combinations these are in.
    """
    each = members.filter(F.size("heads") <= FEW_HEADS).select("owed", F.explode(subsets(F.col("heads"))).alias("common"))
    return each.groupBy("common").agg(F.sum("owed").alias("total"), F.count(F.lit(1)).alias("owing"))


def looked_up(members: DataFrame, asked: DataFrame) -> DataFrame:
    """(combination, total, owing) of what common_sums leaves out: combinations of more than FEW_HEADS heads with all their
    members, and the others with their members under more than FEW_HEADS heads. A member counts once for a combination."""
    each = members.select("member", "owed", (F.size("heads") > FEW_HEADS).alias("wide"), F.explode("heads").alias("head"))
    heads = asked.select("combination", F.explode("combination").alias("head"))
    wide = F.size("combination") > FEW_HEADS
    met = heads.filter(wide).join(each.drop("wide"), "head").union(heads.filter(~wide).join(each.filter("wide").drop("wide"), "head"))
    once = met.groupBy("combination", "member").agg(F.first("owed").alias("owed"))
    return once.groupBy("combination").agg(F.sum("owed").alias("total"), F.count(F.lit(1)).alias("owing"))


def exposure_in_groups(tables: Tables, p: ReportParams, groups: Groups | None = None) -> DataFrame:
    """Exposure of each account over all groups it settles through, as (account, exposure).

    The sum over a union is that over the single groups, less that over what each two have in common, and so on
    (inclusion and exclusion). No list of an account's fellow members is made: members add to the subsets of their
    heads, and an account takes the sums of the subsets of its own. Both are linear in the accounts, as these settle
    through a handful of groups each. Those with more than FEW_HEADS heads are looked up member by member.
    """
    groups = groups or settlement_groups(tables, p)
    accounts = groups.members.groupBy(F.col("member").alias("account")).agg(spelled_heads().alias("combination"))
    asked, members = accounts.select("combination").distinct(), members_by_heads(groups)
    few = asked.filter(F.size("combination") <= FEW_HEADS)
    sums = few.select("combination", F.explode(subsets(F.col("combination"))).alias("common")).join(common_sums(members), "common")
    sign = F.when(F.size("common") % 2 == 1, 1).otherwise(-1)
    parts = sums.select("combination", (F.col("total") * sign).alias("total"), (F.col("owing") * sign).alias("owing"))
    parts = parts.union(looked_up(members, asked)).groupBy("combination")
    # A sum without any amount is missing, not zero.
    exposures = parts.agg(F.when(F.sum("owing") > 0, F.sum("total")).alias("exposure"))
    return accounts.join(exposures, "combination", "left").select("account", "exposure")


def exposure_as_head(tables: Tables, p: ReportParams, groups: Groups | None = None) -> DataFrame:
    """Exposure of each account together with those it settles for, as (account, exposure)."""
    groups = groups or settlement_groups(tables, p)
    totals = (
        groups.sets.join(groups.owed, F.col("member") == F.col("org"), "left").groupBy("head").agg(F.sum("owed").alias("total"))
    )
    both = groups.owed.join(totals, F.col("org") == F.col("head"), "full")
    return both.select(
        F.coalesce("head", "org").alias("account"),
        F.when(F.col("head").isNotNull(), F.col("total")).otherwise(F.col("owed")).alias("exposure"),
    ).filter(F.col("account").isNotNull())


def settling_limits(tables: Tables, p: ReportParams) -> DataFrame:
    """Credit limit of the account that settles for another. Of several, the lowest key counts."""
    known = tables["OrgHeader"].select("OH_PK")
    limits = company_data(tables, p).join(known, F.col("OB_OH") == F.col("OH_PK"), "left_semi")
    limits = limits.select("OB_OH", credit_limit(p).alias("limit"))
    return (
        settlement_parties(tables, p)
        .join(limits, F.col("PR_OH_RelatedParty") == F.col("OB_OH"))
        .groupBy("PR_OH_Parent")
        .agg(first_row([F.col("PR_OH_RelatedParty")], [F.col("limit")])["row"]["limit"].alias("group_limit"))
    )


def with_settlement_credit(accounts: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Add to accounts whose limit counts, that limit, the exposure and whether it is exceeded."""
    if p.is_ar:
        flag = F.col("OB_ARUseSettlementGroupCreditLimit")
        usage = flag.cast("string")
        own = F.when(F.col("has_company_data"), F.when(flag == 1, "N").otherwise("Y"))
    else:
        usage, own = F.lit(None).cast("string"), F.lit("N")
    df = accounts.withColumns({"ARUseSettlementGroupCreditLimit": usage, "UsingOrgAsOwnSettlementGroup": own})

    df = df.join(settling_limits(tables, p), F.col("AccountPK") == F.col("PR_OH_Parent"), "left").drop("PR_OH_Parent")
    groups = settlement_groups(tables, p)
    in_group = exposure_in_groups(tables, p, groups).withColumnsRenamed({"account": "grouped", "exposure": "group_exposure"})
    df = df.join(in_group, F.col("AccountPK") == F.col("grouped"), "left").drop("grouped")
    uses_own = F.col("UsingOrgAsOwnSettlementGroup")
    limit = F.when(uses_own == "N", F.col("group_limit"))
    owed = F.when(uses_own == "N", F.col("group_exposure"))
    if p.is_ar:
        as_head = exposure_as_head(tables, p, groups).withColumnsRenamed({"account": "heading", "exposure": "head_exposure"})
        df = df.join(as_head, F.col("AccountPK") == F.col("heading"), "left").drop("heading")
        limit = limit.when(uses_own == "Y", F.col("CreditLimit"))
        owed = owed.when(uses_own == "Y", F.col("head_exposure"))
    df = df.withColumns({"SettlementGroupCreditLimit": limit, "SettlementGroupOutstandingAmount": owed})
    over = F.col("SettlementGroupOutstandingAmount") > F.col("SettlementGroupCreditLimit")
    return df.withColumn("SettlementGroupOverCreditLimit", F.when(over, "Y").otherwise("N")).drop(
        "group_limit", "group_exposure", "head_exposure"
    )


def over_limit_codes(balances: DataFrame) -> DataFrame:
    """Account codes whose balance exceeds the credit limit, from rows of account, limit and balance.

    Sums are by code and limit, the mark is by code.
    """
    return (
        balances.groupBy("AccountCode", "CreditLimit")
        .agg(F.sum("Balance").alias("total"))
        .filter(F.col("total") > F.col("CreditLimit"))
        .select(F.col("AccountCode").alias("over_code"))
        .distinct()
    )
