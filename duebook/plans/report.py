"""The report: parameters in, one ordered DataFrame out, or ordered files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.params import ReportParams
from duebook.plans.context import build_context
from duebook.plans.detail import detail_order, detail_rows, finished
from duebook.plans.summary import ageing_summary, ageing_summary_order, listing_summary, listing_summary_order
from duebook.sources.tables import Tables


def report_rows(tables: Tables, params: ReportParams) -> tuple[DataFrame, list, Callable[[DataFrame], DataFrame]]:
    """The rows of a report, in no order, the columns that it goes by, and what adds the columns that need not be sorted."""
    ctx = build_context(tables, params)
    if not params.summary_only:
        return detail_rows(tables, params, ctx), detail_order(params), lambda df: finished(df, params, ctx)
    if params.all_transactions:
        return listing_summary(tables, params, ctx), listing_summary_order(params), lambda df: df
    return ageing_summary(tables, params, ctx), ageing_summary_order(params), lambda df: df


def run_report(tables: Tables, params: ReportParams) -> DataFrame:
    """Detail rows, or a summary of the listing or of the ageing, as the parameters say."""
    rows, order, finish = report_rows(tables, params)
    return finish(rows.orderBy(*order))


def write_report(tables: Tables, params: ReportParams, path: str, parts: int) -> DataFrame:
    """Write a report as ordered parts, and return their boundaries: `part`, `rows`, `first` and `last` sort keys.

    Rows are ranged by the sort keys, the last of which tells ties apart, so that no value of a key, however frequent, is
    one task; each part is sorted by itself. What comes before what is known from the boundaries alone.
    """
    rows, order, finish = report_rows(tables, params)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.select("*", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("sort_key"))
    ranged = finish(keyed.repartitionByRange(parts, "sort_key").sortWithinPartitions("sort_key"))
    ranged.withColumn("part", F.spark_partition_id()).write.mode("errorifexists").partitionBy("part").parquet(f"{path}/rows")
    written = rows.sparkSession.read.parquet(f"{path}/rows")
    bounds = written.groupBy("part").agg(F.count("*").alias("rows"), F.min("sort_key").alias("first"), F.max("sort_key").alias("last"))
    bounds.coalesce(1).write.parquet(f"{path}/boundaries")
    return rows.sparkSession.read.parquet(f"{path}/boundaries").orderBy("part")


def read_page(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """Rows start to start + count of a written report, in order. Only the parts that hold them are read."""
    begin, wanted, skipped = 0, [], 0
    for b in spark.read.parquet(f"{path}/boundaries").orderBy("part").select("part", "rows").toLocalIterator():
        if begin < start + count and begin + b["rows"] > start:
            skipped = begin if not wanted else skipped
            wanted.append(b["part"])
        begin += b["rows"]
    rows = spark.read.parquet(f"{path}/rows").filter(F.col("part").isin(wanted)).orderBy("sort_key")
    return rows.offset(start - skipped).limit(count).drop("sort_key", "part")
