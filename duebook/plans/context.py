"""Values looked up once, on the driver, before the plan is built."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from duebook.functions.ageing import day_ageing_dates, period_ageing_dates
from duebook.functions.columns import only_row
from duebook.params import BLANK_DATE, AgeingDates, ReportParams
from duebook.sources.tables import Tables


@dataclass(frozen=True)
class DateRange:
    """from <= date < to; either end may be open."""

    start: datetime | None = None
    end: datetime | None = None


@dataclass(frozen=True)
class RunContext:
    country_code: str | None
    reciprocal_rates: bool
    dates: AgeingDates
    use_outstanding: bool
    match_cutoff: datetime | None = None
    post: DateRange = DateRange()
    due: DateRange = DateRange()
    invoice: DateRange = DateRange()


def _given(value: datetime | None) -> datetime | None:
    return None if value == BLANK_DATE else value


def _next_day(value: datetime | None) -> datetime | None:
    return None if _given(value) is None else value + timedelta(days=1)


def company_context(tables: Tables, p: ReportParams):
    """Country and rate direction of the company."""
    row = only_row(tables["GlbCompany"].filter(F.col("GC_PK") == F.lit(p.company)), "company")
    return (None, False) if row is None else (row["GC_RN_NKCountryCode"], bool(row["GC_IsReciprocal"]))


def period_dates(tables: Tables, p: ReportParams) -> DateRange:
    """First and last day of the period asked for."""
    periods = tables["AccPeriodManagement"]
    row = only_row(periods.filter((F.col("AM_PERIOD") == p.period) & (F.col("AM_GC_COMPANY") == F.lit(p.company))), "period")
    return DateRange() if row is None else DateRange(row["AM_StartDate"], row["AM_EndDate"])


def build_context(tables: Tables, p: ReportParams) -> RunContext:
    country, reciprocal = company_context(tables, p)
    dates = p.ageing_dates
    if dates is None:
        if p.ageing_option == "PER":
            dates = period_ageing_dates(tables["AccPeriodManagement"], p)
        else:
            dates = day_ageing_dates(p, period_dates(tables, p).end if p.period else None)
    ctx = RunContext(country, reciprocal, dates, use_outstanding=dates.report_date >= p.today)
    return _listing_context(tables, p, ctx) if p.all_transactions else ctx


def _listing_context(tables: Tables, p: ReportParams, ctx: RunContext) -> RunContext:
    # A blank end of the post dates asks for current balances, even if a period then sets the dates.
    use_outstanding = p.post_date_to == BLANK_DATE
    posted = DateRange(p.post_date_from, p.post_date_to)
    if p.period:
        posted = period_dates(tables, p)
    cutoff = posted.end
    if _given(posted.end) is not None:
        last_day = posted.end.replace(hour=0, minute=0, second=0, microsecond=0)
        use_outstanding = use_outstanding or last_day >= p.today
        # Postings count before this midnight, matches up to and including it.
        cutoff = last_day + timedelta(days=1)
    return replace(
        ctx,
        use_outstanding=use_outstanding,
        match_cutoff=cutoff,
        post=DateRange(_given(posted.start), _given(cutoff)),
        due=DateRange(_given(p.due_date_from), _next_day(p.due_date_to)),
        invoice=DateRange(_given(p.invoice_date_from), _next_day(p.invoice_date_to)),
    )
