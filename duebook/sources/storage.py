"""Base tables stored in the layout that the report's joins want.

Everything that is joined on a transaction's key (match links, lines, collection lines) is bucketed by it, as the headers
are, with rows sorted within a bucket. A join or a sum by that key then reads the buckets where they lie, and nothing is
shuffled. Headers are also partitioned by company and ledger, which every report asks for. Other tables are small beside
these and are stored as they come.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from duebook.sources.tables import SCHEMAS, Tables

# The column of each table that holds the transaction's key.
TRANSACTION_KEYS = {
    "AccTransactionHeader": "AH_PK",
    "AccTransactionLines": "AL_AH",
    "AccTransactionMatchLink": "AP_AH",
    "AccCollectionOrderLine": "AOL_AH",
}
PARTITIONED_BY = {"AccTransactionHeader": ("AH_GC", "AH_Ledger")}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session shares with all executors. Only a local session may name none."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


@dataclass(frozen=True)
class Layout:
    """Where tables are stored: a folder, a prefix of their names in the session's catalog, and buckets of each transaction table.

    A bucket is what one task joins: at 100 TB some ten thousand buckets hold a few GB of headers, links and lines each.
    """

    folder: str
    prefix: str
    buckets: int

    def table(self, name: str) -> str:
        return f"{self.prefix}_{name}".lower()


def store_table(df: DataFrame, name: str, layout: Layout) -> DataFrame:
    """Write one base table and return what is read from it."""
    spark: SparkSession = df.sparkSession
    key = TRANSACTION_KEYS.get(name)
    if key:
        # Rows of a bucket come from one task, so that a bucket is one sorted file for each partition value.
        writer = df.repartition(layout.buckets, key).write.bucketBy(layout.buckets, key).sortBy(key)
    else:
        writer = df.write
    if name in PARTITIONED_BY:
        writer = writer.partitionBy(*PARTITIONED_BY[name])
    writer.option("path", f"{layout.folder}/{layout.table(name)}").mode("overwrite").saveAsTable(layout.table(name), format="parquet")
    return spark.table(layout.table(name)).select(*df.columns)


def store(tables: Tables, layout: Layout) -> Tables:
    """All base tables, stored now."""
    return Tables.from_frames({name: store_table(tables[name], name, layout) for name in SCHEMAS})


def stored(spark: SparkSession, layout: Layout) -> Tables:
    """Tables that an earlier call has stored."""
    return Tables(lambda name: spark.table(layout.table(name)))


def session_layout(spark: SparkSession, buckets: int | None = None) -> Layout:
    """A new layout that no other session writes to; as many buckets as the session has shuffle partitions."""
    own = f"duebook_{uuid.uuid4().hex[:12]}"
    return Layout(f"{shared_folder(spark)}/{own}", own, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
