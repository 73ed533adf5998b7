from decimal import Decimal as D

import pytest
from conftest import day

from duebook import run_report
from duebook.operators.accounts import account_profile
from duebook.operators.transactions import base_transactions
from duebook.plans.context import build_context
from duebook.plans.detail import DETAIL_COLUMNS, join_profile, ordered


def collected(tables, p):
    return run_report(tables, p).collect()


TYPES = [{"ET_GC": "c1", "ExchangeRateType": t} for t in ("MTH", "BUY")]
RATES = [{"RE_GC": "c1", "RE_RX_NKExCurrency": "JPY", "RE_ExRateType": t, "RE_StartDate": day("2024-03-01"),
          "RE_ExpiryDate": day("2024-03-31"), "RE_SellRate": r} for t, r in (("MTH", 2), ("BUY", 4))]
DATA = [{"OB_OH": "o1", "OB_GC": "c1", "OB_ARCreditLimit": 150, "OB_ARCreditApproved": 1, "OB_AROnCreditHold": 0,
         "OB_ARUseSettlementGroupCreditLimit": 0}]


def test_revalued_detail_splits_gain_and_loss_and_repeats_rows_per_rate(ledger, make):
    headers = [{"AH_PK": "a", "AH_RX_NKTransactionCurrency": "JPY", "AH_ExchangeRate": 3, "AH_OSTotal": 300},
               {"AH_PK": "b", "AH_RX_NKTransactionCurrency": "USD"}]
    tables = ledger(AccTransactionHeader=headers, RefExchangeRate=RATES, ExchangeRateTypes=TYPES)
    rows = collected(tables, make(in_invoice_currency=True))
    assert [c for names in DETAIL_COLUMNS.values() for c in names.split()] == rows[0].__fields__[:85]
    got = {(r["TransactionPK"], r["RE_ExRateType"]): (r["RevaluedLocalEquivalent"], r["GainOnRevaluation"], r["LossOnRevaluation"]) for r in rows}
    assert got == {("a", "MTH"): (D(150), D(50), None), ("a", "BUY"): (D(75), None, D(25)), ("b", None): (D(100), D(0), None)}
    rows = collected(tables, make(in_invoice_currency=True, exchange_rate_types=("MTH",)))
    assert len(rows) == 2
    # The detail report uses the rate even for local balances.
    rows = {r["TransactionPK"]: r for r in collected(tables, make(exchange_rate_types=("MTH",)))}
    assert rows["a"]["RevaluedLocalEquivalent"] == 50 and rows["a"]["LossOnRevaluation"] == 50


def test_several_rates_inflate_summary_sums_but_not_the_limit_mark(ledger, make):
    headers = [{"AH_PK": "a", "AH_RX_NKTransactionCurrency": "JPY"}]
    tables = ledger(AccTransactionHeader=headers, RefExchangeRate=RATES, ExchangeRateTypes=TYPES, OrgCompanyData=DATA)
    (row,) = collected(tables, make(summary_only=True))
    assert row["Balance"] == 200 and row["IsOverLimit"] is None and row["PeriodEndRate"] is None
    assert row["RevaluedLocalEquivalent"] == 200
    rows = collected(tables, make(summary_only=True, in_invoice_currency=True))
    assert [(r["Balance"], r["PeriodEndRate"], r["CurrencyCode"]) for r in rows] == [(D(100), D(2), "JPY"), (D(100), D(4), "JPY")]


def test_limit_mark_counts_rows_the_summary_leaves_out(ledger, make):
    headers = [{"AH_PK": "a", "AH_TransactionCategory": "DBT"}, {"AH_PK": "b"}]
    tables = ledger(AccTransactionHeader=headers, OrgCompanyData=DATA)
    for summary in (True, False):
        (row,) = collected(tables, make(summary_only=summary, disbursement_only=True))
        assert (row["Balance"], row["DSBCharge"], row["IsOverLimit"]) == (D(100), D(100), "*")


def test_summary_lists_terms_once(ledger, make):
    headers = [{"AH_PK": "a"}, {"AH_PK": "b"}, {"AH_PK": "c", "AH_GE": "e2"}]
    terms = [{"PY_OH": "o1", "PY_InvoiceTerm": "INV", "PY_InvoiceDays": 30}, {"PY_OH": "o1", "PY_GE": "e2", "PY_InvoiceTerm": "PIA"}]
    tables = ledger(AccTransactionHeader=headers, OrgCompanyData=DATA, ArTerms=terms)
    (row,) = collected(tables, make(summary_only=True))
    assert (row["InvoiceTerm"], row["Balance"], row["IsOverLimit"], row["AverageExchangeRate"]) == ("30 Days INV,PIA", D(300), "*", D(1))
    tables = ledger(AccTransactionHeader=headers, OrgCompanyData=[{**DATA[0], "OB_AROnCreditHold": 1}], ArTerms=terms)
    assert collected(tables, make(summary_only=True))[0]["InvoiceTerm"] == "COD"


def test_several_settling_accounts_repeat_rows(ledger, make):
    orgs = [{"OH_PK": k, "OH_Code": k.upper(), "OH_FullName": k} for k in ("o1", "s1", "s2")]
    parties = [{"PR_OH_Parent": "o1", "PR_OH_RelatedParty": k, "PR_GC": "c1", "PR_PartyType": "ARS"} for k in ("s1", "s2")]
    tables = ledger(OrgHeader=orgs, OrgRelatedParty=parties, OrgCompanyData=DATA, AccTransactionHeader=[{"AH_PK": "a"}],
                    AccTransactionLines=[{"AL_AH": "a", "AL_LineAmount": 90, "AL_GSTVAT": 10}])
    rows = collected(tables, make(line_amounts=True))
    assert sorted((r["SettlementCode"], r["LineInvoiceExTaxAmount"], r["IsOverLimit"]) for r in rows) == [("S1", D(90), "*"), ("S2", D(90), "*")]
    rows = collected(tables, make(line_amounts=True, literal_fanout=True))
    assert [r["LineInvoiceExTaxAmount"] for r in rows] == [180, 180]
    # The mark sums the repeated rows, and so does the summary.
    rows = collected(tables, make(summary_only=True))
    assert sorted((r["SettlementCode"], r["Balance"], r["IsOverLimit"]) for r in rows) == [("S1", D(100), "*"), ("S2", D(100), "*")]


def test_listing_summaries_roll_up_to_the_plain_one(ledger, make_listing):
    headers = [{"AH_PK": f"t{n}", "AH_TransactionType": t, "AH_LocalTotal": v, "AH_OSTotal": v} for n, (t, v) in
               enumerate([("INV", 10), ("INV", 11), ("CRD", -10), ("CRD", -10), ("CRD", -11)])]
    tables = ledger(AccTransactionHeader=headers)
    plain = {r["TransactionType"]: r for r in collected(tables, make_listing(summary_only=True, group_by="Transaction Type"))}
    assert plain["INV"]["LocalAvg"] == D("10.5") and plain["CRD"]["NoOfTransactions"] == 3
    # Cut, not rounded, towards zero.
    assert plain["CRD"]["LocalAvg"] == D("-10.3333") and plain["CRD"]["LinesSum"] is None
    other = collected(tables, make_listing(summary_only=True, group_by="Settlement Group"))
    assert {r["TransactionType"]: r["InvoiceTotal"] for r in other} == {"INV": 21, "CRD": -31}
    with pytest.raises(ValueError):
        run_report(tables, make_listing(summary_only=True, group_by="Nothing"))


def test_orders_and_overdue(ledger, make_listing):
    headers = [
        {"AH_PK": "a", "AH_TransactionNum": "2", "AH_TransactionType": "INV", "AH_PostDate": day("2024-01-01 12:00"), "AH_InvoiceDate": day("2024-01-03"), "AH_DueDate": day("2024-01-09")},
        {"AH_PK": "b", "AH_TransactionNum": "1", "AH_TransactionType": "INV", "AH_PostDate": day("2024-01-01 23:00"), "AH_InvoiceDate": day("2024-01-02"), "AH_DueDate": None},
        {"AH_PK": "c", "AH_TransactionNum": "3", "AH_TransactionType": "CRD", "AH_PostDate": day("2024-01-02"), "AH_InvoiceDate": day("2024-01-01"), "AH_DueDate": day("2030-01-01")},
    ]
    tables = ledger(AccTransactionHeader=headers)

    def order(text, **more):
        p = make_listing(order_by=text, **more)
        ctx = build_context(tables, p)
        df = join_profile(base_transactions(tables, p, ctx), account_profile(tables, p, ctx, frozenset()), p)
        return "".join(r["TransactionPK"] for r in ordered(df, p).collect())

    assert order("TRN", overdue_only=True) == "bac"
    assert order("Post Date, Type then Transaction Number") == "bac"
    assert order("Invoice Date, Type then Transaction Number") == "cba"
    assert order("Invoice Date, Type then Transaction Number", legacy_invoice_sort=True) == "bac"
    assert order("Transaction Type then Transaction Number") == "cba"
    assert order("Transaction Number then Transaction Type") == "bac"
    assert order("Transaction Number then Transaction Type", overdue_only=True) == "a"


def test_over_limit_only_leaves_accounts_over_their_group_limit(ledger, make):
    orgs = [{"OH_PK": k, "OH_Code": k.upper()} for k in ("o1", "o2")]
    data = [{**DATA[0], "OB_OH": "o1", "OB_ARCreditLimit": 1}, {**DATA[0], "OB_OH": "o2"}]
    headers = [{"AH_PK": "a"}, {"AH_PK": "b", "AH_OH": "o2"}, {"AH_PK": "c", "AH_OH": "unknown"}]
    tables = ledger(OrgHeader=orgs, OrgCompanyData=data, AccTransactionHeader=headers)
    for summary in (True, False):
        (row,) = collected(tables, make(summary_only=summary, over_limit_only=True))
        assert row["AccountCode"] == "O1" and row["IsOverLimit"] is None and row["SettlementGroupOverCreditLimit"] == "Y"
    # Without the filter, a transaction without an account is reported too.
    rows = collected(tables, make())
    assert [(r["AccountPK"], r["SettlementGroupOverCreditLimit"]) for r in rows][0] == ("unknown", "N")


def test_company_is_told_apart_in_later_matches(ledger, make):
    headers = [{"AH_PK": "a", "AH_OutstandingAmount": 10}, {"AH_PK": "r", "AH_TransactionType": "REC", "AH_GC": "c2", "AH_PostDate": day("2024-05-01")}]
    links = [{"AP_AH": k, "AP_MatchGroupNum": "g", "AP_Amount": 5, "AP_MatchDate": day("2024-02-01")} for k in ("a", "r")]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    later = "MatchedInFuturePeriodInLocalCurrency"
    assert [r[later] for r in collected(tables, make(future_matches_apart=True))] == [0]
    assert [r[later] for r in collected(tables, make(future_matches_apart=True, future_match_all_companies=True))] == [5]
