"""Row hashes, exact cuts of an ordered table and running totals, all without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions.selection import select_ranks
from kerbline.shared import saved, sized

HASH_SPAN = 16**13
SLICE_ROWS = 1_000_000


def row_hash(*keys: str, seed: int = 42) -> Column:
    """A 52-bit integer from the md5 of the key columns: the same for any partitioning or engine."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def literal(value, dtype: str) -> Column:
    if dtype.startswith("timestamp") or dtype == "date":
        return F.lit(str(value)).cast(dtype)
    return F.lit(value).cast(dtype)


def _kth(df: DataFrame, column: str, k: int):
    """(value of the k-th row in order of ``column``, rows strictly before it, rows equal to it)."""
    if dict(df.dtypes)[column] == "string":
        # Text breaks ties only: what is in question by now are the rows of one earlier value.
        col = F.col(column)
        counts = df.where(col.isNotNull()).groupBy(col.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        return _pick(counts, k) or _no_cut(column)
    row = select_ranks(df, [], column, F.array(F.lit(k - 1))).first()
    return (row["value"], row["before"], row["equal"]) if row else _no_cut(column)


def _no_cut(column: str):
    raise DataError(f"too few rows have a value in {column}")


def _pick(counts: DataFrame, k: int):
    running = Window.orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    row = (
        counts.withColumn("stop", F.sum("rows").over(running))
        .where(F.col("stop") >= k)
        .orderBy("stop")
        .first()
    )
    return None if row is None else (row["value"], row["stop"] - row["rows"], row["rows"])


def first_rows(df: DataFrame, order: list[str], k: int, total: int | None = None) -> Column:
    """A predicate true on exactly the first ``k`` rows in the given order.

    The cut is found column by column from counts alone, so no row is moved, and the result is a
    plain comparison that reaches the Parquet reader. The order columns must identify a row; rows
    with a null in them come last and cannot be part of the first rows.
    """
    total = df.count() if total is None else total
    if k <= 0:
        return F.lit(False)
    if k >= total:
        return F.lit(True)
    types = dict(df.dtypes)
    scope, taken, left = F.lit(True), F.lit(False), k
    for column in order:
        value, before, equal = _kth(df.where(scope), column, left)
        here = literal(value, types[column])
        taken = taken | (scope & (F.col(column) < here))
        scope = scope & (F.col(column) == here)
        left -= before
        if left == equal:
            return taken | scope
    raise DataError(f"order columns {order} do not identify a row at the cut")


def running_totals(df: DataFrame, order: str, sums: list[str], descending: bool = False, slices: int | None = None) -> DataFrame:
    """Add ``before_<c>`` (total of ``c`` over rows ordered before this one) for unique ``order`` values.

    Rows are dealt by ranges of ``order`` into slices of about ``SLICE_ROWS``, however many that takes. Each slice is summed, the
    totals of the slices before are its offset, and the window runs inside the slice. The dealt rows are kept, so that
    a slice stays the same when it is read twice.
    """
    rank = F.col(order).desc() if descending else F.col(order).asc()
    slices = slices or 1 + df.count() // SLICE_ROWS
    cut = saved(df.repartitionByRange(slices, rank).withColumn("slice", F.spark_partition_id()))
    ahead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("slice").agg(*[F.sum(c).alias(f"t_{c}") for c in sums])
    offsets = offsets.select("slice", *[F.coalesce(F.sum(f"t_{c}").over(ahead), F.lit(0)).alias(f"o_{c}") for c in sums])
    inner = Window.partitionBy("slice").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(sized(offsets), "slice")
        .select(
            *df.columns,
            *[(F.coalesce(F.sum(c).over(inner), F.lit(0)) + F.col(f"o_{c}")).alias(f"before_{c}") for c in sums],
        )
    )
