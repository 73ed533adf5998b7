from decimal import Decimal as D

from conftest import day

from duebook.operators.accounts import account_profile
from duebook.operators.transactions import base_transactions, ledger_amounts, ledger_transactions
from duebook.plans.context import build_context
from duebook.plans.detail import join_profile


def pks(df):
    return sorted(r["TransactionPK"] for r in df.collect())


def run(stage, tables, p):
    ctx = build_context(tables, p)
    return join_profile(stage(tables, p, ctx), account_profile(tables, p, ctx, frozenset({"country"})), p)


def values(df, *columns):
    return {r["TransactionPK"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_no_transaction_types_means_no_rows(ledger, make_listing):
    tables = ledger(AccTransactionHeader=[{"AH_PK": "t1"}])
    assert pks(run(base_transactions, tables, make_listing())) == ["t1"]
    assert pks(run(base_transactions, tables, make_listing(transaction_types=""))) == []


def test_listing_drops_and_ageing_keeps_unknown_dimensions(ledger, make, make_listing):
    headers = [{"AH_PK": "ok"}, {"AH_PK": "org", "AH_OH": "none"}, {"AH_PK": "dep", "AH_GE": "none"},
               {"AH_PK": "branch", "AH_GB": "none"}, {"AH_PK": "cur", "AH_RX_NKTransactionCurrency": "ZZZ"}]
    tables = ledger(AccTransactionHeader=headers)
    assert pks(run(base_transactions, tables, make_listing())) == ["ok"]
    assert pks(run(base_transactions, tables, make())) == ["branch", "cur", "dep", "ok", "org"]
    assert pks(run(base_transactions, tables, make(currencies="USD,ZZZ"))) == ["branch", "dep", "ok", "org"]
    assert pks(run(base_transactions, tables, make(accounts="ONE"))) == ["branch", "cur", "dep", "ok"]


def test_excluded_countries_also_drop_unknown_ones(ledger, make):
    orgs = [{"OH_PK": "o1", "OH_Code": "ONE", "OH_RL_NKClosestPort": "AUSYD"}, {"OH_PK": "o2", "OH_Code": "TWO"}]
    tables = ledger(OrgHeader=orgs, AccTransactionHeader=[{"AH_PK": "a"}, {"AH_PK": "b", "AH_OH": "o2"}])
    assert pks(run(base_transactions, tables, make(excluded_countries="NZ"))) == ["a"]
    assert pks(run(base_transactions, tables, make(excluded_countries="AU"))) == []
    assert pks(run(base_transactions, tables, make())) == ["a", "b"]


def test_posted_flag_blank_is_off_and_absent_matches_nothing(ledger, make):
    tables = ledger(AccTransactionHeader=[{"AH_PK": "a"}, {"AH_PK": "b", "AH_PostToGL": None}])
    assert pks(run(base_transactions, tables, make(posted_to_gl=""))) == ["a", "b"]
    assert pks(run(base_transactions, tables, make(posted_to_gl="Y"))) == ["a"]
    assert pks(run(base_transactions, tables, make(posted_to_gl=None))) == []


COLLECTIONS = {
    "AccCollectionOrder": [{"ACO_PK": "q1", "ACO_ACB": "ddb"}, {"ACO_PK": "q2", "ACO_ACB": "chq"}],
    "AccCollectionBatch": [{"ACB_PK": "ddb", "ACB_GC": "c1", "ACB_Type": "DDB"}, {"ACB_PK": "chq", "ACB_GC": "c2", "ACB_Type": "CHQ"}],
    "AccCollectionOrderLine": [
        {"AOL_AH": "a", "AOL_ACO": "q1", "AOL_IsCancelled": 0},
        {"AOL_AH": "b", "AOL_ACO": "q2", "AOL_IsCancelled": 0},
        {"AOL_AH": "c", "AOL_ACO": "q1", "AOL_IsCancelled": 1},
    ],
}


def test_active_collections(ledger, make, make_listing):
    headers = [{"AH_PK": k} for k in "abcd"]
    tables = ledger(AccTransactionHeader=headers, **COLLECTIONS)
    # Only ageing asks for the batch's company.
    assert pks(run(base_transactions, tables, make())) == ["a", "c", "d"]
    assert pks(run(base_transactions, tables, make_listing())) == ["a", "b", "c", "d"]
    assert pks(run(base_transactions, tables, make_listing(excluded_batch_types="DDB"))) == ["b", "c", "d"]
    assert pks(run(base_transactions, tables, make_listing(include_active_batch=False))) == ["c", "d"]
    assert pks(run(base_transactions, tables, make_listing(not_in_active_batch_only="Y"))) == ["c", "d"]


def test_collection_line_without_transaction_leaves_only_allowed_ones(ledger, make_listing):
    lines = [*COLLECTIONS["AccCollectionOrderLine"], {"AOL_AH": None, "AOL_ACO": "q1", "AOL_IsCancelled": 0}]
    tables = ledger(AccTransactionHeader=[{"AH_PK": k} for k in "abcd"], **{**COLLECTIONS, "AccCollectionOrderLine": lines})
    assert pks(run(base_transactions, tables, make_listing())) == ["a", "b"]
    assert pks(run(base_transactions, tables, make_listing(include_active_batch=False))) == []


def test_matches_on_the_next_midnight_count_but_postings_do_not(ledger, make_listing):
    headers = [{"AH_PK": "a"}, {"AH_PK": "late", "AH_PostDate": day("2024-02-01")}]
    links = [{"AP_AH": "a", "AP_Amount": 30, "AP_MatchDate": day("2024-02-01")},
             {"AP_AH": "a", "AP_Amount": 5, "AP_MatchDate": day("2024-02-01 00:01")}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    got = values(run(base_transactions, tables, make_listing(post_date_to=day("2024-01-31"))), "Balance", "BalanceInLocal")
    assert got == {"a": (D(70), D(0))}


def test_ageing_puts_later_matches_back_and_drops_zero_balances(ledger, make):
    headers = [
        {"AH_PK": "open", "AH_OutstandingAmount": 40, "AH_FullyPaidDate": None},
        {"AH_PK": "paid later", "AH_OutstandingAmount": 0, "AH_FullyPaidDate": day("2024-04-05")},
        {"AH_PK": "paid", "AH_OutstandingAmount": 0, "AH_FullyPaidDate": day("2024-03-31")},
        {"AH_PK": "zero", "AH_OutstandingAmount": 0},
        {"AH_PK": "inb", "AH_TransactionType": "INB"},
        {"AH_PK": "future", "AH_PostDate": day("2024-04-01")},
    ]
    links = [{"AP_AH": "paid later", "AP_Amount": 100, "AP_MatchDate": day("2024-04-05")},
             {"AP_AH": "open", "AP_Amount": 60, "AP_MatchDate": day("2024-03-31")}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    assert values(run(base_transactions, tables, make()), "Balance") == {"open": (D(40),), "paid later": (D(100),)}
    # On the report day itself current balances hold.
    assert pks(run(base_transactions, tables, make(current_date_time=day("2024-03-31 09:00")))) == ["open"]


def test_payment_status_splits_the_listing(ledger, make_listing):
    headers = [{"AH_PK": "ful"}, {"AH_PK": "par"}, {"AH_PK": "unp"}, {"AH_PK": "nil", "AH_LocalTotal": 0}]
    links = [{"AP_AH": "ful", "AP_Amount": 100, "AP_MatchDate": day("2024-01-20")},
             {"AP_AH": "par", "AP_Amount": 1, "AP_MatchDate": day("2024-01-20")}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)

    def of(status):
        return pks(run(base_transactions, tables, make_listing(payment_status=status, post_date_to=day("2024-02-28"))))

    assert of("FUL") == ["ful", "nil"] and of("PAR") == ["par"] and of("UNP") == ["unp"]
    assert of("NON") == ["ful", "nil", "par", "unp"]


def test_future_matches_follow_the_group_of_a_later_payment(ledger, make):
    headers = [{"AH_PK": "inv", "AH_OutstandingAmount": 0},
               {"AH_PK": "other"},
               {"AH_PK": "rec", "AH_TransactionType": "REC", "AH_PostDate": day("2024-04-02"), "AH_OH": "o9"}]
    links = [{"AP_AH": "inv", "AP_MatchGroupNum": "g1", "AP_Amount": 60, "AP_MatchDate": day("2024-03-02")},
             {"AP_AH": "inv", "AP_MatchGroupNum": "g2", "AP_Amount": 40, "AP_MatchDate": day("2024-03-02")},
             {"AP_AH": "rec", "AP_MatchGroupNum": "g1", "AP_Amount": -60, "AP_MatchDate": day("2024-03-02")}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionMatchLink=links)
    later = "MatchedInFuturePeriodInLocalCurrency"
    shown = values(run(ledger_amounts, tables, make(future_matches_apart=True, summary_only=True)), "Balance", later)
    assert shown == {"inv": (D(0), D(60)), "other": (D(100), D(0))}
    taken = values(run(ledger_amounts, tables, make(future_matches_apart=True, exclude_future_matches=True)), "Balance", later)
    assert taken["inv"] == (D(-60), D(60))
    p = make(future_matches_apart=True, current_date_time=day("2024-03-31"))
    assert values(run(ledger_amounts, tables, p), "Balance")["inv"] == (D(60),)
    # In the detail report a zero balance is dropped.
    assert "inv" not in values(run(ledger_amounts, tables, make(future_matches_apart=True)), "Balance")


def test_invoice_currency_rounds_to_the_currency_and_takes_whole_totals(ledger, make):
    headers = [
        {"AH_PK": "part", "AH_ExchangeRate": 1.5, "AH_OutstandingAmount": 33.33, "AH_RX_NKTransactionCurrency": "JPY"},
        {"AH_PK": "mils", "AH_ExchangeRate": 0.3333, "AH_OutstandingAmount": 33.33, "AH_RX_NKTransactionCurrency": "KWD"},
        {"AH_PK": "whole", "AH_ExchangeRate": 1.5, "AH_OSTotal": 151},
        {"AH_PK": "free", "AH_ExchangeRate": 0, "AH_OutstandingAmount": 50},
        {"AH_PK": "local", "AH_OutstandingAmount": 12.34},
        {"AH_PK": "chance", "AH_ExchangeRate": 2, "AH_OutstandingAmount": 50, "AH_OSTotal": 777},
        {"AH_PK": "ratio", "AH_ExchangeRate": 2, "AH_OutstandingAmount": 50, "AH_RX_NKTransactionCurrency": "ZZZ"},
    ]
    tables = ledger(AccTransactionHeader=headers)
    got = values(run(ledger_amounts, tables, make(in_invoice_currency=True)), "Balance")
    assert got == {
        "part": (D(50),), "mils": (D("11.109"),), "whole": (D(151),), "free": (D(0),), "local": (D("12.34"),),
        # Converted, the balance happens to equal the local total, so the invoice total replaces it.
        "chance": (D(777),),
        # Without a currency there are no decimals to round to.
        "ratio": (None,),
    }
    company = [{"GC_PK": "c1", "GC_RN_NKCountryCode": "AU", "GC_IsReciprocal": True}]
    got = values(run(ledger_amounts, ledger(AccTransactionHeader=headers, GlbCompany=company), make(in_invoice_currency=True)), "Balance")
    assert got["part"] == (D(22),) and got["free"] == (D(50),) and got["mils"] == (D(100),)


def test_payables_turn_signs_but_not_lines(ledger, make_listing):
    headers = [{"AH_PK": "a", "AH_Ledger": "AP", "AH_LocalTotal": -100, "AH_OSTotal": -100, "AH_InvoiceAmount": -90, "AH_GSTAmount": -10}]
    lines = [{"AL_AH": "a", "AL_LineAmount": -60, "AL_GSTVAT": -6}, {"AL_AH": "a", "AL_LineAmount": -30, "AL_GSTVAT": -4}]
    tables = ledger(AccTransactionHeader=headers, AccTransactionLines=lines)
    p = make_listing(ledger="AP", line_amounts=True)
    got = values(run(ledger_transactions, tables, p), "InvoiceTotal", "Balance", "InvoiceExTax", "TaxAmount", "LineInvoiceExTaxAmount", "LineTaxAmount")
    assert got == {"a": (D(100), D(100), D(90), D(10), D(-90), D(-10))}


def test_line_sums_are_for_invoices_and_notes_only(ledger, make):
    headers = [{"AH_PK": "a"}, {"AH_PK": "r", "AH_TransactionType": "REC"}, {"AH_PK": "n"}]
    lines = [{"AL_AH": k, "AL_LineAmount": 5, "AL_GSTVAT": 1} for k in ("a", "a", "r")]
    got = values(run(ledger_transactions, ledger(AccTransactionHeader=headers, AccTransactionLines=lines), make(line_amounts=True)), "LineInvoiceExTaxAmount")
    assert got == {"a": (D(10),), "r": (None,), "n": (None,)}


def test_header_terms_and_type_texts(ledger, make_listing):
    headers = [
        {"AH_PK": "days", "AH_InvoiceTermDays": 7}, {"AH_PK": "months", "AH_InvoiceTerm": "MIC", "AH_InvoiceTermDays": 30},
        {"AH_PK": "cod", "AH_InvoiceTerm": "COD"}, {"AH_PK": "rec", "AH_TransactionType": "REC"},
    ]
    got = values(run(base_transactions, ledger(AccTransactionHeader=headers), make_listing()), "InvoiceTerm", "TransactionTypeDesc")
    assert got == {"days": ("INV 7   Days", "Invoice"), "months": ("MIC 30  Months", "Invoice"), "cod": ("COD", "Invoice"), "rec": ("", "Receipts")}


def test_disbursement_categories_differ_by_ledger_and_path(ledger, make, make_listing):
    headers = [{"AH_PK": c + lg, "AH_TransactionCategory": c, "AH_Ledger": lg} for c in ("DBT", "DCU", "XXX") for lg in ("AR", "AP")]
    tables = ledger(AccTransactionHeader=headers)

    def marked(p):
        return sorted(k for k, v in values(run(base_transactions, tables, p), "IsDSBInvoice").items() if v[0] == "DSB")

    assert marked(make()) == ["DBTAR", "DCUAR"] and marked(make_listing()) == ["DBTAR", "DCUAR"]
    assert marked(make_listing(ledger="AP")) == ["DBTAP"] and marked(make(ledger="AP")) == []


def test_management_group_replaces_the_branch_list_by_text(ledger, make):
    branches = [{"GB_PK": k, "GB_GC": "c1", "GB_Code": c, "GB_AccountingGroupCode": g}
                for k, c, g in (("b1", "SYD", "G1"), ("b2", "MEL", "G1"), ("b3", "YD", "G1"), ("b4", "BNE", "G2"))]
    tables = ledger(GlbBranch=branches, AccTransactionHeader=[{"AH_PK": k, "AH_GB": k} for k in ("b1", "b2", "b3", "b4")])
    assert pks(run(base_transactions, tables, make(branch_management_code="G1"))) == ["b1", "b2", "b3"]
    # YD is found inside SYD.
    assert pks(run(base_transactions, tables, make(branch_management_code="G1", branches="SYD,BNE"))) == ["b1", "b3"]
    assert pks(run(base_transactions, tables, make(branch_management_code="G9"))) == []


def test_buckets_add_up_to_the_balance(ledger, make):
    headers = [{"AH_PK": f"t{n}", "AH_DueDate": None if n == 0 else day("2023-09-01").replace(month=1 + n % 12, year=2023 + n % 2),
                "AH_PostDate": day("2023-09-15"), "AH_InvoiceDate": day("2023-12-31")} for n in range(24)]
    tables = ledger(AccTransactionHeader=headers)
    from duebook.functions.ageing import BUCKETS

    for mode, option in (("DUE", "PER"), ("PST", "PER"), ("INV", "PER"), ("PST", "DAY"), ("INV", "DAY")):
        p = make(aged_by=mode, ageing_option=option, local_equivalent=True)
        for row in run(ledger_transactions, tables, p).collect():
            filled = [row[b] for b in BUCKETS if row[b] is not None]
            assert filled == [row["Balance"]], (mode, option, row)
            assert [row[b + "InLocal"] for b in BUCKETS if row[b + "InLocal"] is not None] == [row["BalanceInLocal"]]


def test_missing_boundaries_merge_older_buckets(ledger, make):
    from dataclasses import replace

    from conftest import DATES

    headers = [{"AH_PK": "old", "AH_DueDate": day("2020-01-01")}, {"AH_PK": "jan", "AH_DueDate": day("2024-01-05")}]
    tables = ledger(AccTransactionHeader=headers)
    dates = replace(DATES, p3_start=None, p4_start=None)
    got = values(run(ledger_transactions, tables, make(ageing_dates=dates)), "Period2Total", "Period3Total", "Period4Total")
    assert got == {"old": (D(100), None, None), "jan": (D(100), None, None)}
    dates = replace(dates, p1_start=None, p2_start=None)
    got = values(run(ledger_transactions, tables, make(ageing_dates=dates)), "PeriodCurrent", "Period1Total")
    assert got == {"old": (D(100), None), "jan": (D(100), None)}
