"""Transactions that are on an active collection batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.columns import in_list
from duebook.params import ReportParams
from duebook.sources.tables import Tables


def collection_flags(tables: Tables, p: ReportParams) -> DataFrame:
    """One row per transaction on an active order line, with whether one of its batches is allowed.

    Only the ageing path looks at the batch's company.
    """
    lines = tables["AccCollectionOrderLine"].filter(F.col("AOL_IsCancelled") == 0)
    batches = tables["AccCollectionBatch"]
    if not p.all_transactions:
        batches = batches.filter(F.col("ACB_GC") == F.lit(p.company))
    if p.excluded_batch_types:
        batches = batches.filter(~in_list(F.col("ACB_Type"), p.excluded_batch_types))
    allowed_orders = (
        tables["AccCollectionOrder"]
        .join(batches, F.col("ACO_ACB") == F.col("ACB_PK"), "left_semi")
        .select(F.col("ACO_PK").alias("allowed_order"))
    )
    return (
        lines.filter(F.col("AOL_AH").isNotNull())
        .join(allowed_orders, F.col("AOL_ACO") == F.col("allowed_order"), "left")
        .groupBy("AOL_AH")
        .agg(F.max(F.col("allowed_order").isNotNull()).alias("batch_allowed"))
    )


def without_active_collections(headers: DataFrame, tables: Tables, p: ReportParams) -> DataFrame:
    """Drop receivables on active collection lines, save those whose batch may be reported.

    A line without a transaction makes "not on any line" unknown for every header, so
    then only the allowed ones are left. The flags come by one keyed join; a join under
    OR would compare every header with every line.
    """
    if not p.is_ar:
        return headers
    keep_allowed = p.include_active_batch and not p.not_in_active_batch_only
    keyless = tables["AccCollectionOrderLine"].filter((F.col("AOL_IsCancelled") == 0) & F.col("AOL_AH").isNull())
    off_batch = F.col("AOL_AH").isNull() & ~keyless.select("AOL_AH").limit(1).exists()
    kept = off_batch | F.coalesce(F.col("batch_allowed"), F.lit(False)) if keep_allowed else off_batch
    flagged = headers.join(collection_flags(tables, p), F.col("AH_PK") == F.col("AOL_AH"), "left")
    return flagged.filter(kept).drop("AOL_AH", "batch_allowed")
