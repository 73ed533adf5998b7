"""Column expressions shared by the report's operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"


def money(value: Column) -> Column:
    """A value as it is stored in a money column: four decimals."""
    return value.cast(MONEY)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def moment(value: datetime) -> Column:
    """A date without zone as a literal that can be pushed to the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def only_row(df: DataFrame, what: str) -> Row | None:
    """The row of a lookup, or none. Several rows are an error, as they are in a scalar subquery."""
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"more than one {what} found where one is looked up")
    return rows[0] if rows else None


def clock(now: datetime | None) -> Column:
    return F.localtimestamp() if now is None else moment(now)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which the condition is true; rows where it is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def in_list(column: Column, values: Sequence[Any]) -> Column:
    return column.isin(list(values)) if values else F.lit(False)


def three_places(number: Column) -> Column:
    """A whole number as text of at most three characters; one that needs more is shown as a star."""
    return F.when(number.between(-99, 999), number.cast("string")).when(number.isNotNull(), "*")


def first_row(order: Sequence[Column], values: Sequence[Column], where: Column | None = None) -> Column:
    """The values of the first row of a group by an order, as one struct.

    It is a plain minimum, so it is combined before the shuffle and a group of any
    size passes through. Nulls come first in the order, as in an ascending sort.
    """
    row = F.struct(
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("order"),
        F.struct(*values).alias("row"),
    )
    return F.min(row if where is None else F.when(where, row))


def round_by_subunit(value: Column, ratio: Column) -> Column:
    """Round to the decimals of a currency: one less than the digits of its sub-unit ratio.

    A missing ratio gives a missing result. Money keeps four decimals at most.
    """
    decimals = F.length(ratio.cast("string")) - 1
    rounded = F.when(decimals == 0, F.round(value, 0).cast(MONEY))
    for n in (1, 2, 3):
        rounded = rounded.when(decimals == n, F.round(value, n).cast(MONEY))
    return rounded.when(decimals >= 4, value.cast(MONEY))


def divide_money(total: Column, count: Column) -> Column:
    """Money divided by a count, cut to four decimals. Exact at any size of the total."""
    units = (total * 10000).cast("decimal(38,0)")
    whole = units - units % count.cast("decimal(38,0)")
    return (whole / count / 10000).cast(MONEY)


def adjusted_credit_limit(limit: Column, increase: Column, expiry: Column, as_of: datetime) -> Column:
    """A credit limit with its temporary increase, as long as that has not expired."""
    extra = F.when(expiry >= moment(as_of), increase)
    return money(limit + F.coalesce(extra, zero()))


def join_sparse(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, row_key: str) -> DataFrame:
    """Left join on a key that many rows lack.

    Rows without it match nothing, yet a shuffle would send all of them to one task. A
    second key, derived from the row's own key, spreads them. The lookup key is dropped.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(F.col(row_key))).otherwise(F.lit(0).cast("bigint"))
    keyed = lookup.withColumn("lookup_spread", F.when(F.col(lookup_key).isNotNull(), F.lit(0).cast("bigint")))
    joined = df.withColumn("row_spread", spread).join(
        keyed, (F.col(key) == F.col(lookup_key)) & (F.col("row_spread") == F.col("lookup_spread")), "left"
    )
    return joined.drop("row_spread", "lookup_spread", lookup_key)
