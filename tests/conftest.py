from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duebook.params import AgeingDates, ReportParams  # noqa: E402
from duebook.sources.tables import OPTIONAL_COLUMNS, SCHEMAS, Tables  # noqa: E402

TYPES = {"key": "string", "text": "string", "int": "int", "boolean": "boolean", "money": "decimal(19,4)",
         "rate": "decimal(18,9)", "date": "timestamp_ntz"}


@pytest.fixture(scope="session")
def spark():
    from bench import session

    spark = session("4")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    return spark


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


# Values a micro header has unless a test says otherwise.
HEADER = {
    "AH_OH": "o1", "AH_GB": "b1", "AH_GE": "e1", "AH_GC": "c1", "AH_Ledger": "AR", "AH_TransactionType": "INV",
    "AH_TransactionCategory": "", "AH_LocalTotal": 100, "AH_OutstandingAmount": 100, "AH_OSTotal": 100,
    "AH_InvoiceAmount": 90, "AH_GSTAmount": 10, "AH_ExchangeRate": 1, "AH_RX_NKTransactionCurrency": "USD",
    "AH_PostDate": day("2024-01-10"), "AH_DueDate": day("2024-02-10"), "AH_InvoiceDate": day("2024-01-09"),
    "AH_InvoiceTerm": "INV", "AH_InvoiceTermDays": 30, "AH_PostToGL": "Y", "AH_AgreedPaymentMethodOverride": "",
}
DIMENSIONS = {
    "GlbCompany": [{"GC_PK": "c1", "GC_RN_NKCountryCode": "AU", "GC_IsReciprocal": False}],
    "GlbBranch": [{"GB_PK": "b1", "GB_GC": "c1", "GB_Code": "SYD", "GB_BranchName": "Sydney", "GB_AccountingGroupCode": "G1"}],
    "GlbDepartment": [{"GE_PK": "e1", "GE_Code": "FIS"}],
    "RefCurrency": [
        {"RX_PK": "usd", "RX_Code": "USD", "RX_SubUnitRatio": 100},
        {"RX_PK": "jpy", "RX_Code": "JPY", "RX_SubUnitRatio": 1},
        {"RX_PK": "kwd", "RX_Code": "KWD", "RX_SubUnitRatio": 1000},
    ],
    "OrgHeader": [{"OH_PK": "o1", "OH_Code": "ONE", "OH_FullName": "One Ltd", "OH_RL_NKClosestPort": "AUSYD"}],
    "RefUNLOCO": [{"RL_Code": "AUSYD", "RL_RN_NKCountryCode": "AU"}],
    "RefCountry": [{"RN_Code": "AU", "RN_Desc": "Australia"}],
    "ExchangeRateTypes": [{"ET_GC": "c1", "ExchangeRateType": "MTH"}],
}
DATES = AgeingDates(
    report_date=day("2024-03-31"), current_start=day("2024-03-01"), current_end=day("2024-03-31"),
    p1_start=day("2024-02-01"), p2_start=day("2024-01-01"), p3_start=day("2023-12-01"), p4_start=day("2023-11-01"),
    p1_plus_start=day("2024-04-01"), p2_plus_start=day("2024-05-01"), p3_plus_start=day("2024-06-01"),
)


@pytest.fixture(scope="session")
def ledger(spark):
    """Tables from a few rows each; those not given are small dimensions or empty."""

    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, datetime):
            return f"timestamp_ntz '{value}'"
        return repr(value)

    def frame(name: str, given: list[dict]):
        schema = {c: TYPES[kind] for kind, names in SCHEMAS[name].items() for c in names.split()}
        extra = {c for r in given for c in r} & set(OPTIONAL_COLUMNS.get(name, ()))
        schema |= {c: "string" for c in sorted(extra)}
        if name == "AccTransactionHeader":
            given = [{**HEADER, **r} for r in given]
        unknown = {c for r in given for c in r} - set(schema)
        assert not unknown, unknown
        columns = ", ".join(f"cast({c} as {t}) as {c}" for c, t in schema.items())
        if not given:
            return spark.sql("select " + ", ".join(f"cast(null as {t}) as {c}" for c, t in schema.items()) + " where false")
        values = ", ".join("(" + ", ".join(literal(r.get(c)) for c in schema) + ")" for r in given)
        return spark.sql(f"select {columns} from values {values} as t({', '.join(schema)})")

    def build(**rows) -> Tables:
        assert set(rows) <= set(SCHEMAS)
        return Tables(lambda name: frame(name, rows.get(name, DIMENSIONS.get(name, []))))

    return build


@pytest.fixture
def make():
    def params(**more) -> ReportParams:
        values = {"company": "c1", "ledger": "AR", "current_date_time": day("2024-06-15"), "now": day("2024-03-31"),
                  "ageing_dates": DATES}
        return ReportParams(**{**values, **more})

    return params


@pytest.fixture
def make_listing(make):
    def params(**more) -> ReportParams:
        return make(**{"all_transactions": True, "transaction_types": "INV,CRD,ADJ,REC,PAY", **more})

    return params
