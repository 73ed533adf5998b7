"""Ageing: the boundary dates and the buckets they cut a balance into."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.columns import MONEY, moment, only_row
from duebook.params import AgeingDates, ReportParams

# The bucket columns in output order.
BUCKETS = (
    "NotDue1Total",
    "NotDue2Total",
    "NotDue3Total",
    "NotDue4Total",
    "Period1Total",
    "Period2Total",
    "Period3Total",
    "Period4Total",
    "PeriodCurrent",
)
LOCAL_SUFFIX = "InLocal"
DATE_COLUMN = {"DUE": "DueDate", "PST": "PostDate", "INV": "InvoiceDate"}

_NEIGHBOURS = {
    "p1_start": ("lag", 1),
    "p2_start": ("lag", 2),
    "p3_start": ("lag", 3),
    "p4_start": ("lag", 4),
    "p1_plus_start": ("lead", 1),
    "p2_plus_start": ("lead", 2),
    "p3_plus_start": ("lead", 3),
}


def period_boundaries(periods: DataFrame) -> DataFrame:
    """Every accounting period with the starts of the four before it and the three after it."""
    in_order = Window.partitionBy("AM_GC_COMPANY").orderBy("AM_StartDate")
    return periods.select(
        "AM_GC_COMPANY",
        "AM_PERIOD",
        F.col("AM_EndDate").alias("report_date"),
        F.col("AM_StartDate").alias("current_start"),
        F.col("AM_EndDate").alias("current_end"),
        *[getattr(F, f)("AM_StartDate", n).over(in_order).alias(name) for name, (f, n) in _NEIGHBOURS.items()],
    )


def period_ageing_dates(periods: DataFrame, p: ReportParams) -> AgeingDates:
    """Ageing dates of the period asked for, or of the one the current date falls in."""
    rows = period_boundaries(periods.filter(F.col("AM_GC_COMPANY") == F.lit(p.company)))
    if p.period:
        rows = rows.filter(F.col("AM_PERIOD") == p.period)
    else:
        rows = rows.filter((F.col("current_start") <= moment(p.today)) & (F.col("current_end") >= moment(p.today)))
    row = only_row(rows.drop("AM_GC_COMPANY", "AM_PERIOD"), "accounting period")
    if row is None:
        if p.all_transactions:
            return AgeingDates(p.today)
        raise ValueError("no accounting period found for the ageing dates")
    return AgeingDates(**row.asDict())


def day_ageing_dates(p: ReportParams, report_date: datetime | None = None) -> AgeingDates:
    """Ageing dates counted in days before and after the report date."""
    base = report_date or p.today

    def shifted(days: int | None, sign: int) -> datetime | None:
        return None if days is None else base + sign * timedelta(days=days)

    return AgeingDates(
        report_date=base,
        current_start=base,
        current_end=base,
        p1_start=shifted(p.day1, -1),
        p2_start=shifted(p.day2, -1),
        p3_start=shifted(p.day3, -1),
        p4_start=shifted(p.day4, -1),
        p1_plus_start=shifted(p.day1, 1),
        p2_plus_start=shifted(p.day2, 1),
        p3_plus_start=shifted(p.day3, 1),
    )


def _from(day: Column, start: datetime | None, open_start: bool = False) -> Column:
    """day >= start. Without a start: everything if the range is open there, else nothing."""
    return F.lit(open_start) if start is None else day >= moment(start)


def _before(day: Column, end: datetime | None, open_end: bool = False) -> Column:
    return F.lit(open_end) if end is None else day < moment(end)


def bucket_conditions(p: ReportParams, d: AgeingDates) -> dict[str, Column]:
    """The condition of each bucket that the chosen kind of ageing fills.

    A bucket whose older neighbour has no boundary takes all that is older.
    """
    if p.aged_by not in DATE_COLUMN:
        return {}
    day = F.col(DATE_COLUMN[p.aged_by])
    starts = [d.current_start, d.p1_start, d.p2_start, d.p3_start, d.p4_start]

    if p.aged_by != "DUE" and p.ageing_option != "PER":
        # Counted in days, the first period still counts as current.
        edges = starts[1:]
        conditions = {"PeriodCurrent": day.isNull() | _from(day, edges[0])}
        for n in (1, 2, 3):
            conditions[f"Period{n}Total"] = _from(day, edges[n]) & _before(day, edges[n - 1])
        conditions["Period4Total"] = _before(day, edges[3])
        return conditions

    current = _from(day, d.current_start) if d.p1_start else F.lit(True)
    if p.aged_by == "DUE":
        current = current & _before(day, d.p1_plus_start, open_end=True)
    conditions = {"PeriodCurrent": day.isNull() | current}
    for n in (1, 2, 3):
        if starts[n]:
            older = starts[n] if starts[n + 1] else None
            conditions[f"Period{n}Total"] = _from(day, older, open_start=True) & _before(day, starts[n - 1])
    if starts[4]:
        conditions["Period4Total"] = _before(day, starts[3])
    if p.aged_by == "DUE":
        plus = [d.p1_plus_start, d.p2_plus_start, d.p3_plus_start]
        conditions["NotDue1Total"] = _from(day, plus[0]) & _before(day, plus[1], open_end=True)
        conditions["NotDue2Total"] = _from(day, plus[1]) & _before(day, plus[2], open_end=True)
        conditions["NotDue3Total"] = _from(day, plus[2])
    return conditions


def with_buckets(df: DataFrame, p: ReportParams, d: AgeingDates) -> DataFrame:
    """Add the bucket columns: of the balance, and of the local balance when it is shown."""
    conditions = bucket_conditions(p, d)
    columns = {}
    for name in BUCKETS:
        for suffix, value, shown in (("", "Balance", True), (LOCAL_SUFFIX, "BalanceInLocal", p.local_equivalent)):
            condition = conditions.get(name) if shown else None
            columns[name + suffix] = (
                F.lit(None).cast(MONEY) if condition is None else F.when(condition, F.col(value)).cast(MONEY)
            )
    return df.withColumns(columns)
