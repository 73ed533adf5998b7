"""Receivables and payables reporting on Spark DataFrames."""

from duebook.params import BLANK_DATE, AgeingDates, ReportParams
from duebook.plans.report import run_report
from duebook.sources.tables import Tables

__all__ = ["AgeingDates", "BLANK_DATE", "ReportParams", "Tables", "run_report"]
