"""Period-end snapshots of what was matched, so that balances as of a date do not read all match links.

A snapshot holds, for one period end, the sum of each transaction's links up to and including that day. What was matched up to
any moment is the latest snapshot before it and the links since, which are stored by month; what was matched after it is all
that was matched less that. Snapshots and links are bucketed by the transaction's key, so that they join headers where these
lie.

Links that come later are appended, and with them their share in every snapshot they belong to, however far back they
are dated; a snapshot's sum is that of its rows. So the result is that of the links themselves at any moment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions.columns import moment, money
from duebook.sources.storage import Layout
from duebook.sources.tables import Tables

LINKS, SNAPSHOTS = "MatchLinksByMonth", "MatchSnapshots"
LINK_COLUMNS = ("AP_AH", "AP_Amount", "AP_MatchDate")


def month_of(day: Column) -> Column:
    """Months since the year 0; links without a date have none."""
    return F.year(day) * 12 + F.month(day)


def month_number(day: datetime) -> int:
    return day.year * 12 + day.month


@dataclass(frozen=True)
class MatchSnapshots:
    """Stored links and snapshots of a layout; ends: the moments of the snapshots, ascending."""

    spark: SparkSession
    layout: Layout
    ends: tuple[datetime, ...]

    @staticmethod
    def build(tables: Tables, layout: Layout, ends: Sequence[datetime]) -> MatchSnapshots:
        """Store the links by month, and a snapshot for each end.

        The sums are those of the stored links, which lie by transaction: the links are shuffled once and worked out once.
        """
        links = tables["AccTransactionMatchLink"]
        made = MatchSnapshots(links.sparkSession, layout, tuple(sorted(set(ends))))
        made._store_links(links, "overwrite")
        made._store_sums(made.spark.table(layout.table(LINKS)), "overwrite")
        return made

    def append(self, links: DataFrame) -> None:
        """Add links that came since; their dates may lie before any snapshot."""
        self._store_links(links, "append")
        self._store_sums(self._by_transaction(links.select(*LINK_COLUMNS)), "append")

    def _store_links(self, links: DataFrame, mode: str) -> None:
        links = links.select(*LINK_COLUMNS, month_of(F.col("AP_MatchDate")).alias("AP_Month"))
        self._store(self._by_transaction(links), LINKS, "AP_Month", mode)

    def _store_sums(self, links: DataFrame, mode: str) -> None:
        """Store a snapshot for each end, of links that lie by transaction."""
        ends = F.array(*[moment(e) for e in self.ends]).cast("array<timestamp_ntz>")
        # Each link counts in the snapshots from its day on.
        spread = links.select("AP_AH", "AP_Amount", F.explode(F.filter(ends, lambda e: F.col("AP_MatchDate") <= e)).alias("upto"))
        sums = spread.groupBy("upto", "AP_AH").agg(F.sum("AP_Amount").cast("decimal(29,4)").alias("matched"))
        self._store(sums.select("AP_AH", "matched", F.date_format("upto", "yyyyMMddHHmmss").alias("AP_End")), SNAPSHOTS, "AP_End", mode)

    def _by_transaction(self, links: DataFrame) -> DataFrame:
        return links.repartition(self.layout.buckets, "AP_AH")

    def _store(self, df: DataFrame, name: str, by: str, mode: str) -> None:
        dealt = df.write.bucketBy(self.layout.buckets, "AP_AH").sortBy("AP_AH").partitionBy(by)
        table = self.layout.table(name)
        dealt.option("path", f"{self.layout.folder}/{table}").mode(mode).saveAsTable(table, format="parquet")

    def _links(self, after: datetime | None, upto: datetime | None) -> DataFrame:
        """Sums of the links after one moment and up to another; only the months between are read."""
        links = self.spark.table(self.layout.table(LINKS))
        if after is not None:
            links = links.filter((F.col("AP_Month") >= month_number(after)) & (F.col("AP_MatchDate") > moment(after)))
        if upto is not None:
            links = links.filter((F.col("AP_Month") <= month_number(upto)) & (F.col("AP_MatchDate") <= moment(upto)))
        # Links without a date are matched at no time.
        links = links.filter(F.col("AP_MatchDate").isNotNull())
        return links.groupBy("AP_AH").agg(F.sum("AP_Amount").alias("amount"))

    def _snapshot(self, end: datetime) -> DataFrame:
        rows = self.spark.table(self.layout.table(SNAPSHOTS)).filter(F.col("AP_End") == f"{end:%Y%m%d%H%M%S}")
        return rows.groupBy("AP_AH").agg(F.sum("matched").alias("amount"))

    def _last_end(self, at: datetime | None) -> datetime | None:
        return max((e for e in self.ends if at is None or e <= at), default=None)

    def terms_upto(self, at: datetime | None) -> list[tuple[int, DataFrame]]:
        """What add up to the matches until a moment, or to all of them: sums of (AP_AH, amount), each with its sign."""
        end = self._last_end(at)
        return ([(1, self._snapshot(end))] if end is not None else []) + ([] if end is not None and end == at else [(1, self._links(end, at))])

    def terms_after(self, at: datetime) -> list[tuple[int, DataFrame]]:
        """What add up to the matches after a moment."""
        last = self._last_end(None)
        if last is None or at >= last:
            return [(1, self._links(at, None))]
        return self.terms_upto(None) + [(-sign, df) for sign, df in self.terms_upto(at)]


def with_matched(headers: DataFrame, terms: list[tuple[int, DataFrame]]) -> DataFrame:
    """Headers with `matched`, the sum of the terms; each joins by the transaction's key. Null where none has the transaction."""
    total, kept = None, headers.columns
    known = F.lit(False)
    for n, (sign, df) in enumerate(terms):
        headers = headers.join(df.select(F.col("AP_AH").alias(f"term_key{n}"), F.col("amount").alias(f"term{n}")), F.col("AH_PK") == F.col(f"term_key{n}"), "left")
        part = sign * F.coalesce(F.col(f"term{n}"), F.lit(0).cast("decimal(29,4)"))
        total = part if total is None else total + part
        known = known | F.col(f"term_key{n}").isNotNull()
    return headers.select(*kept, F.when(known, money(total)).alias("matched"))
