"""The base tables of the report and how they are read.

Each table is read through a resolver, so that Parquet folders, catalog tables and
any other Spark source serve alike. Only the columns listed here are selected, so a
column-oriented source reads no others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from copy import copy
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from duebook.sources.snapshots import MatchSnapshots

# The columns of each table, by kind. Keys keep the type they come with.
SCHEMAS: dict[str, dict[str, str]] = {
    "GlbCompany": {"key": "GC_PK", "text": "GC_RN_NKCountryCode", "boolean": "GC_IsReciprocal"},
    "AccPeriodManagement": {"key": "AM_GC_COMPANY", "int": "AM_PERIOD", "date": "AM_StartDate AM_EndDate"},
    "GlbBranch": {"key": "GB_PK GB_GC", "text": "GB_Code GB_BranchName GB_AccountingGroupCode"},
    "GlbDepartment": {"key": "GE_PK", "text": "GE_Code"},
    "GlbStaff": {"text": "GS_Code GS_FullName"},
    "AccTransactionHeader": {
        "key": "AH_PK AH_OH AH_GB AH_GE AH_JH AH_GC",
        "text": "AH_Ledger AH_TransactionType AH_TransactionNum AH_TransactionCategory AH_Desc "
        "AH_ConsolidatedInvoiceRef AH_RX_NKTransactionCurrency AH_InvoiceTerm AH_PostToGL AH_SystemCreateUser "
        "AH_AgreedPaymentMethodOverride AH_MatchStatus AH_MatchStatusReasonCode",
        "money": "AH_LocalTotal AH_OutstandingAmount AH_OSTotal AH_InvoiceAmount AH_GSTAmount",
        "rate": "AH_ExchangeRate",
        "date": "AH_PostDate AH_DueDate AH_InvoiceDate AH_FullyPaidDate",
        "int": "AH_InvoiceTermDays",
    },
    "AccTransactionLines": {"key": "AL_AH", "money": "AL_LineAmount AL_GSTVAT"},
    "AccTransactionMatchLink": {"key": "AP_AH AP_MatchGroupNum", "money": "AP_Amount", "date": "AP_MatchDate"},
    "AccCollectionOrderLine": {"key": "AOL_AH AOL_ACO", "int": "AOL_IsCancelled"},
    "AccCollectionOrder": {"key": "ACO_PK ACO_ACB"},
    "AccCollectionBatch": {"key": "ACB_PK ACB_GC", "text": "ACB_Type"},
    "OrgHeader": {"key": "OH_PK", "text": "OH_Code OH_FullName OH_RL_NKClosestPort"},
    "OrgCompanyData": {
        "key": "OB_OH OB_GC OB_GB_ControllingBranch OB_OJ_ARDebtorGroup OB_OG_APCreditorGroup",
        "money": "OB_ARCreditLimit OB_ARTemporaryCreditLimitIncrease OB_APCreditLimit",
        "date": "OB_ARTemporaryCreditLimitIncreaseExpiry",
        "text": "OB_ARCategory OB_APCategory OB_ARConsolidatedAccountingCategory OB_ARCreditRating",
        "int": "OB_ARCreditApproved OB_AROnCreditHold OB_ARUseSettlementGroupCreditLimit",
    },
    "OrgDebtorGroup": {"key": "OJ_PK", "text": "OJ_Code"},
    "OrgCreditorGroup": {"key": "OG_PK", "text": "OG_Code"},
    "OrgRelatedParty": {"key": "PR_OH_Parent PR_OH_RelatedParty PR_GC", "text": "PR_PartyType"},
    "OrgContact": {"key": "OC_PK OC_OH OC_OH_AddressOverride", "text": "OC_ContactName OC_Phone", "int": "OC_IsActive"},
    "OrgDocument": {"key": "OD_OC", "text": "OD_DocumentGroup", "int": "OD_DefaultContact"},
    "OrgAddress": {"key": "OA_PK OA_OH", "text": "OA_Phone OA_RL_NKRelatedPortCode"},
    "OrgAddressCapability": {"key": "PZ_OA", "int": "PZ_IsMainAddress", "text": "PZ_AddressType"},
    "RefUNLOCO": {"text": "RL_Code RL_RN_NKCountryCode"},
    "RefCountry": {"text": "RN_Code RN_Desc"},
    "RefCurrency": {"key": "RX_PK", "text": "RX_Code", "int": "RX_SubUnitRatio"},
    "RefExchangeRate": {
        "key": "RE_GC",
        "text": "RE_RX_NKExCurrency RE_ExRateType",
        "date": "RE_StartDate RE_ExpiryDate",
        "rate": "RE_SellRate",
    },
    "JobHeader": {"key": "JH_PK", "text": "JH_JobNum"},
    # Lookups that stand in for functions kept outside the base tables.
    "StaffAssignments": {"key": "O8_OH", "text": "O8_Role O8_Department O8_GS_NKPersonResponsible"},
    "ArTerms": {"key": "PY_OH PY_GE PY_GB", "text": "PY_InvoiceTerm", "int": "PY_InvoiceDays"},
    "CompanyNames": {"key": "CN_OH", "text": "CompanyName"},
    "MatchStatus": {"text": "Code Description"},
    "MatchStatusReason": {"text": "Code Description"},
    "ExchangeRateTypes": {"key": "ET_GC", "text": "ExchangeRateType"},
}

# Columns a lookup may have beside those above: rows for one company, branch or ledger only.
OPTIONAL_COLUMNS = {
    "StaffAssignments": ("O8_GC",),
    "ArTerms": ("PY_GC",),
    "CompanyNames": ("CN_GC", "CN_GB", "CN_Ledger"),
    "MatchStatus": ("GC",),
    "MatchStatusReason": ("GC",),
}

_SPARK_TYPES = {
    "text": "string",
    "int": "int",
    "boolean": "boolean",
    "money": "decimal(19,4)",
    "rate": "decimal(18,9)",
    "date": "timestamp_ntz",
}

# Text columns of fixed length, whose values may carry trailing blanks.
_PADDED = frozenset(
    "GB_Code GC_RN_NKCountryCode GE_Code GS_Code AH_Ledger AH_TransactionType AH_TransactionCategory "
    "AH_RX_NKTransactionCurrency AH_InvoiceTerm RL_Code RL_RN_NKCountryCode RN_Code RX_Code "
    "RE_RX_NKExCurrency RE_ExRateType PR_PartyType OB_ARCategory OB_APCategory "
    "OB_ARConsolidatedAccountingCategory OB_ARCreditRating O8_Role O8_Department "
    "O8_GS_NKPersonResponsible PY_InvoiceTerm ACB_Type PZ_AddressType OD_DocumentGroup".split()
)


class Tables:
    """Access to the base tables with their columns and types settled."""

    def __init__(self, resolve: Callable[[str], DataFrame], trim_padding: bool = False):
        self._resolve = resolve
        self._trim = trim_padding
        self._seen: dict[str, DataFrame] = {}
        #: Period-end snapshots of the match links, where there are any.
        self.snapshots: MatchSnapshots | None = None

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, **options) -> Tables:
        """One Parquet data set per table, named after it, below a folder."""
        return cls(lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}"), **options)

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str, **options) -> Tables:
        """Tables of a catalog schema."""
        return cls(lambda name: spark.table(f"{schema}.{name}"), **options)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame], **options) -> Tables:
        return cls(frames.__getitem__, **options)

    def with_snapshots(self, snapshots: MatchSnapshots) -> Tables:
        """The same tables; balances as of a date are then worked out from the snapshots."""
        tables = copy(self)
        tables.snapshots = snapshots
        return tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._settle(name, self._resolve(name))
        return self._seen[name]

    def _settle(self, name: str, df: DataFrame) -> DataFrame:
        present = dict(df.dtypes)
        columns = []
        for kind, names in SCHEMAS[name].items():
            for column in names.split():
                value = F.col(column)
                wanted = _SPARK_TYPES.get(kind)
                # A cast or trim hides the column from scan pushdown, so apply it only where needed.
                if wanted and present.get(column) != wanted:
                    value = value.cast(wanted)
                if self._trim and column in _PADDED:
                    value = F.rtrim(value)
                columns.append(value.alias(column))
        columns += [F.col(c) for c in OPTIONAL_COLUMNS.get(name, ()) if c in present]
        return df.select(*columns)


def of_company(df: DataFrame, column: str, company) -> DataFrame:
    """Rows of one company, where the lookup tells companies apart."""
    return df.filter(F.col(column) == company) if column in df.columns else df
