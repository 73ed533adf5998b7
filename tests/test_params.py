from datetime import datetime

import pytest
from conftest import day

from duebook.functions.ageing import day_ageing_dates
from duebook.params import BLANK_DATE, ReportParams, split_list
from duebook.plans.context import build_context


def test_lists_are_split_trimmed_and_blank_means_off():
    assert split_list(" a, b,,c ") == ("a", "b", "c")
    assert split_list("") is None and split_list(None) is None and split_list([]) is None
    assert split_list(",") == ()
    assert split_list([1, 2]) == (1, 2)


def test_report_arguments_take_the_known_names():
    p = ReportParams.from_report_arguments(
        {"@Company": 1, "LedgerType": "AP", "@CurrentDateTime": datetime(2024, 1, 2), "SummaryOnly": "Y", "@OrgList": "A,B"}
    )
    assert (p.ledger, p.summary_only, p.accounts) == ("AP", True, ("A", "B"))
    with pytest.raises(ValueError):
        ReportParams.from_report_arguments({"@Nothing": 1})


def test_flags_other_than_y_are_off(make):
    assert make(overdue_only="1").overdue_only is False
    assert make(overdue_only="Y").overdue_only is True


def test_ledger_is_checked(make):
    with pytest.raises(ValueError):
        make(ledger="GL")


def test_day_dates_count_from_the_report_day(make):
    d = day_ageing_dates(make(ageing_option="DAY", day1=10, day4=None), day("2024-03-31"))
    assert d.p1_start == day("2024-03-21") and d.p1_plus_start == day("2024-04-10") and d.p4_start is None


def test_blank_post_date_end_asks_for_current_balances_even_with_a_period(ledger, make_listing):
    tables = ledger(
        AccPeriodManagement=[
            {"AM_PERIOD": 5, "AM_GC_COMPANY": "c1", "AM_StartDate": day("2024-01-01"), "AM_EndDate": day("2024-01-31")}
        ]
    )
    ctx = build_context(tables, make_listing(post_date_to=BLANK_DATE, period=5))
    assert ctx.use_outstanding and ctx.post.start == day("2024-01-01") and ctx.post.end == day("2024-02-01")
    ctx = build_context(tables, make_listing(post_date_to=day("2024-01-31 10:00")))
    assert not ctx.use_outstanding and ctx.match_cutoff == day("2024-02-01")
    assert build_context(tables, make_listing(post_date_to=day("2024-06-15"))).use_outstanding
    assert build_context(tables, make_listing()).use_outstanding is False


def test_upper_ends_are_exclusive_next_day_and_keep_their_time(ledger, make_listing):
    ctx = build_context(ledger(), make_listing(due_date_to=day("2024-01-31 10:00"), invoice_date_from=BLANK_DATE))
    assert ctx.due.end == day("2024-02-01 10:00") and ctx.invoice.start is None
