import random
from collections import defaultdict
from decimal import Decimal as D

import pytest
from conftest import day

from duebook.operators import contacts, credit
from duebook.operators.accounts import CREDIT, account_profile
from duebook.operators.terms import resolve_terms
from duebook.plans.context import build_context


def rows(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def orgs(*keys):
    return [{"OH_PK": k, "OH_Code": k.upper(), "OH_FullName": k.title(), "OH_RL_NKClosestPort": "AUSYD"} for k in keys]


def brute_force_exposure(parties, users, owed):
    """Exposure in groups and as head, by listing members."""
    members = defaultdict(set)
    for parent, head in parties:
        if parent in users:
            members[head].add(parent)
    in_group, as_head = {}, {}
    for account in {m for ms in members.values() for m in ms}:
        heads = [h for h, ms in members.items() if account in ms]
        union = set(heads).union(*[members[h] for h in heads])
        amounts = [owed[m] for m in union if m in owed]
        in_group[account] = sum(amounts) if amounts else None
    for account in set(owed) | set(members):
        amounts = [owed[m] for m in members.get(account, set()) | {account} if m in owed]
        as_head[account] = sum(amounts) if amounts else None
    return in_group, as_head


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exposure_matches_brute_force_with_many_groups_per_account(ledger, make, seed):
    rng = random.Random(seed)
    keys = [f"k{n:02d}" for n in range(24)]
    # One group holds a third of the accounts; many accounts have two or three groups.
    parties = [(k, "k00") for k in keys[:8]] + [(k, "k01") for k in keys[:8:2]]
    parties += [(rng.choice(keys), rng.choice(keys)) for _ in range(30)]
    parties += parties[:3]
    users = set(rng.sample(keys, 18))
    headers = [{"AH_PK": f"t{n}", "AH_OH": rng.choice(keys[:20]), "AH_OutstandingAmount": rng.randint(-50, 90)} for n in range(60)]
    headers += [{"AH_PK": "x1", "AH_OH": "k03", "AH_TransactionType": "INB"}, {"AH_PK": "x2", "AH_OH": "k03", "AH_Ledger": "AP"}]
    tables = ledger(
        OrgHeader=orgs(*keys),
        OrgRelatedParty=[{"PR_OH_Parent": a, "PR_OH_RelatedParty": b, "PR_GC": "c1", "PR_PartyType": "ARS"} for a, b in parties]
        + [{"PR_OH_Parent": "k05", "PR_OH_RelatedParty": "k09", "PR_GC": "c2", "PR_PartyType": "ARS"}],
        OrgCompanyData=[{"OB_OH": k, "OB_GC": "c1", "OB_ARUseSettlementGroupCreditLimit": int(k in users)} for k in keys],
        AccTransactionHeader=headers,
    )
    owed = defaultdict(int)
    for h in headers[:60]:
        owed[h["AH_OH"]] += h["AH_OutstandingAmount"]
    in_group, as_head = brute_force_exposure(parties, users, owed)
    p = make()
    got = {k: v[0] for k, v in rows(credit.exposure_in_groups(tables, p), "account", "exposure").items()}
    assert got == in_group
    got = {k: v[0] for k, v in rows(credit.exposure_as_head(tables, p), "account", "exposure").items()}
    assert got == as_head


def test_settlement_credit_takes_the_limit_that_counts(ledger, make):
    tables = ledger(
        OrgHeader=orgs("own", "member", "head", "bare"),
        OrgCompanyData=[
            {"OB_OH": "own", "OB_GC": "c1", "OB_ARCreditLimit": 50, "OB_ARTemporaryCreditLimitIncrease": 10,
             "OB_ARTemporaryCreditLimitIncreaseExpiry": day("2024-06-15"), "OB_ARUseSettlementGroupCreditLimit": 0},
            {"OB_OH": "member", "OB_GC": "c1", "OB_ARCreditLimit": 1, "OB_APCreditLimit": 1, "OB_ARUseSettlementGroupCreditLimit": 1},
            {"OB_OH": "head", "OB_GC": "c1", "OB_ARCreditLimit": 70, "OB_ARTemporaryCreditLimitIncrease": 9,
             "OB_ARTemporaryCreditLimitIncreaseExpiry": day("2024-06-14"), "OB_APCreditLimit": 5},
        ],
        OrgRelatedParty=[{"PR_OH_Parent": "member", "PR_OH_RelatedParty": "head", "PR_GC": "c1", "PR_PartyType": t} for t in ("ARS", "APS")],
        AccTransactionHeader=[{"AH_PK": k, "AH_OH": k, "AH_OutstandingAmount": 61} for k in ("own", "member")],
    )
    names = ("ARUseSettlementGroupCreditLimit", "UsingOrgAsOwnSettlementGroup", "SettlementGroupCreditLimit",
             "SettlementGroupOutstandingAmount", "SettlementGroupOverCreditLimit")
    p = make()
    got = rows(account_profile(tables, p, build_context(tables, p), frozenset({CREDIT})), "AccountCode", *names)
    assert got == {
        "OWN": ("0", "Y", D(60), D(61), "Y"),
        "MEMBER": ("1", "N", D(70), D(61), "N"),
        "HEAD": (None, "Y", D(70), D(61), "N"),
        "BARE": (None, None, None, None, "N"),
    }
    p = make(ledger="AP")
    got = rows(account_profile(tables, p, build_context(tables, p), frozenset({CREDIT})), "AccountCode", *names)
    assert got["MEMBER"] == (None, "N", D(5), None, "N") and got["OWN"][1:3] == ("N", None)


def test_first_staff_is_chosen_before_looking_at_the_staff_table(ledger, make):
    staff = [{"O8_OH": o, "O8_Role": r, "O8_Department": d, "O8_GS_NKPersonResponsible": s} for o, r, d, s in (
        ("a", "SAL", "ALL", "B"), ("a", "SAL", "ALL", "A"), ("a", "SAL", "FIS", "0"), ("a", "CUS", "ALL", "B"),
        ("b", "SAL", "ALL", "GONE"), ("b", "SAL", "ALL", "Z"))]
    tables = ledger(StaffAssignments=staff, GlbStaff=[{"GS_Code": c, "GS_FullName": "Mx " + c} for c in "ABZ"])
    got = rows(contacts.assigned_staff(tables, make()), "O8_OH", "SalesRep", "SalesRepName", "CustomerService", "CreditController")
    assert got == {"a": ("A", "Mx A", "B", None), "b": (None, None, None, None)}


CONTACT = {"OC_IsActive": 1}
OFFICES = [("own1", "mainless", "1"), ("own2", "two", "2"), ("own3", "two", "3"), ("own4", "noname", "4"), ("own5", "override", "5")]


def contact_tables(ledger, **more):
    people = [
        ("p1", "main", "Zoe", "10", 1, None), ("p2", "main", "Amy", "11", 1, None), ("p3", "main", "Bob", "12", 0, None),
        ("p4", "mainless", "Al", None, 1, None), ("p5", "away", "Cy", "13", 1, "override"), ("p6", "two", "Di", "", 1, None),
        ("p7", "lost", "Ed", "14", 1, "two"), ("p8", "twice", "Flo", "15", 1, None), ("p9", "twice", "Flo", "16", 1, "override"),
    ]
    documents = [("p1", "ALL", 1), ("p2", "A/R", 0), ("p3", "A/R", 1), ("p4", "A/R", None), ("p5", "A/P", 1), ("p5", "ALL", 0),
                 ("p6", "ALL", 1), ("p7", "A/R", 1), ("p8", "A/R", 0), ("p9", "A/R", 1)]
    return ledger(**{
        "OrgHeader": orgs("main", "mainless", "away", "two", "lost", "twice", "noname"),
        "OrgContact": [{"OC_PK": a, "OC_OH": b, "OC_ContactName": c, "OC_Phone": d, "OC_IsActive": e, "OC_OH_AddressOverride": f}
                       for a, b, c, d, e, f in people],
        "OrgDocument": [{"OD_OC": a, "OD_DocumentGroup": b, "OD_DefaultContact": c} for a, b, c in documents],
        "OrgAddress": [{"OA_PK": a, "OA_OH": b, "OA_Phone": c, "OA_RL_NKRelatedPortCode": "AUSYD" if b == "two" else "NZAKL"}
                       for a, b, c in OFFICES],
        "OrgAddressCapability": [{"PZ_OA": a, "PZ_IsMainAddress": 1, "PZ_AddressType": "OFC"} for a, _, _ in OFFICES],
        **more,
    })


def reached(tables, p):
    ctx = build_context(tables, p)
    from pyspark.sql import functions as F

    base = tables["OrgHeader"].select(F.col("OH_PK").alias("AccountPK"))
    return rows(contacts.with_contacts(base, tables, p, ctx), "AccountPK", "ContactName", "ContactPhoneNo", "ContactInfo")


def test_phone_waterfall(ledger, make):
    got = reached(contact_tables(ledger), make())
    assert got == {
        # The ledger's own document group comes before ALL; inactive contacts do not count.
        "main": ("Amy", "11", "Amy (Ph:11)"),
        # No phone of the contact's own, but a sole main office of the account.
        "mainless": ("Al", "1", "Al (Ph:1)"),
        # The contact is reached through the override's sole office.
        "away": ("Cy", "5", "Cy (Ph:5)"),
        # Two main offices are no sole one, but one is the first in the company's country.
        "two": ("Di", "2", "Di (Ph:2)"),
        "lost": ("Ed", "2", "Ed (Ph:2)"),
        # Of two contacts with the chosen name the lower key counts.
        "twice": ("Flo", "15", "Flo (Ph:15)"),
        "noname": (None, "4", "No Contact Available (Ph:4)"),
    }
    # Payables look at other documents; without a phone there is no text.
    got = reached(contact_tables(ledger), make(ledger="AP"))
    assert got["main"][0] == "Zoe" and got["away"][0] == "Cy" and got["lost"] == (None, None, None)


def test_country_office_can_be_looked_up_per_account(ledger, make):
    offices = OFFICES + [("own6", "lost", "6"), ("own7", "lost", "7")]
    more = {
        "OrgAddress": [{"OA_PK": a, "OA_OH": b, "OA_Phone": c, "OA_RL_NKRelatedPortCode": "AUSYD"} for a, b, c in offices],
        "OrgAddressCapability": [{"PZ_OA": a, "PZ_IsMainAddress": 1, "PZ_AddressType": "OFC"} for a, _, _ in offices],
        "OrgContact": [],
    }
    tables = contact_tables(ledger, **more)
    assert reached(tables, make())["two"][1] is None
    got = reached(tables, make(country_office_scope="per_org"))
    assert got["two"][1] == "2" and got["lost"][1] == "6"


def test_strict_contacts_refuse_shared_names(ledger, make):
    with pytest.raises(Exception, match="share the name"):
        reached(contact_tables(ledger), make(strict_contacts=True))


def test_terms_fit_as_closely_as_they_can(ledger, make):
    records = [("a", None, None, "INV", 30), ("a", "e1", None, "COD", 0), ("a", None, "b1", "PIA", 0), ("a", "e2", "b2", "MIC", 2),
               ("b", None, None, "DEF", 0), ("c", "e1", None, "INV", 7)]
    tables = ledger(ArTerms=[{"PY_OH": o, "PY_GE": e, "PY_GB": b, "PY_InvoiceTerm": t, "PY_InvoiceDays": d} for o, e, b, t, d in records])
    keys = [("a", None, "e1", "b1"), ("a", None, "e2", "b1"), ("a", None, "e2", "b2"), ("a", None, "e3", "b3"), ("a", None, None, "b1"),
            ("b", "a", "e3", "b3"), ("b", None, "e1", "b1"), ("b", "b", "e1", "b1"), ("c", "a", "e1", "b1"), ("c", "a", "e2", "b2")]
    spark = tables["ArTerms"].sparkSession
    text = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in k) + ")" for k in keys)
    df = spark.sql(f"select * from values {text} as t(AccountPK, SettlementPK, AH_GE, AH_GB)")
    got = {tuple(r)[:4]: r["InvoiceTerm"] for r in resolve_terms(df, tables, make()).collect()}
    assert got == dict(zip(keys, ["COD", "PIA", "2 Months MIC", "30 Days INV", "PIA", "30 Days INV", "0 Days ", "0 Days DEF", "7 Days INV", "0 Days "]))


def test_company_names_prefer_the_branch(ledger, make):
    names = [{"CN_OH": "a", "CN_GB": None, "CompanyName": "A"}, {"CN_OH": "a", "CN_GB": "b1", "CompanyName": "B"},
             {"CN_OH": "b", "CN_GB": "b2", "CompanyName": "C"}]
    tables = ledger(CompanyNames=names)
    assert rows(contacts.additional_company_names(tables, make(branch="b1")), "CN_OH", "AdditionalCompanyName") == {"a": ("B",)}
    assert rows(contacts.additional_company_names(tables, make()), "CN_OH", "AdditionalCompanyName") == {"a": ("A",)}
