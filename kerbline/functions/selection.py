"""Exact selection of ranks in groups by radix, from counts only.

Values are mapped to 64-bit integers of the same order. Each round counts the rows of the cells still in question by the next
16 bits, all groups and ranks together, with the least and greatest value of each cell. A rank falls into one cell; it is
found when all values of the cell are equal, after four rounds at the latest. No sample is drawn, no row is sorted or
moved, and counting combines map-side, so neither a large group nor a frequent value meets in one task: what a
group brings together are at most 65,536 counts.

Rounds end when no cell is in question; what a round leaves is a row for each group and rank. The scopes that
rows are joined with are broadcast only when their number is bounded or counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.shared import attach, saved, sized

ROUND_BITS = 16


def ordered_bits(value: Column, dtype: str) -> Column:
    """A bigint that orders as the value does; equal for equal values only. Null stays null."""
    if dtype in ("double", "float"):
        # Adding zero makes both zeros one; negative numbers have their other bits turned.
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("bigint")
        return F.when(value.isNotNull(), F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1))))
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("bigint")
    if dtype == "date":
        return F.unix_date(value).cast("bigint")
    if dtype == "timestamp":
        return F.unix_micros(value)
    if dtype == "timestamp_ntz":
        seconds = F.unix_date(value.cast("date")).cast("bigint") * 86_400 + F.hour(value) * 3600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
    raise DataError(f"{dtype} has no order of bits")


def same(left: list[str], right: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def _cells(rows: DataFrame, scope: list[str], shift: int) -> DataFrame:
    """For each scope the counts by the next bits, in order: scope..., cells (p, n, lo, hi), size and total."""
    cells = rows.groupBy(*scope, F.shiftright("key", shift).alias("p")).agg(
        F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("w").alias("s")
    )
    return cells.groupBy(*scope).agg(
        F.sort_array(F.collect_list(F.struct("p", "n", "lo", "hi"))).alias("cells"), F.sum("n").alias("size"), F.sum("s").alias("total")
    )


def _found(row: DataFrame, keep: list[str], value_type: str) -> DataFrame:
    """The cell of each of ``ranks`` (rank, inside: place among the rows of the cells, before: rows of the group below the cell)."""
    cell = f"struct<p:bigint,n:bigint,lo:{value_type},hi:{value_type}>"
    walk = f"""transform(ranks, r -> aggregate(cells,
        named_struct('rank', r.rank, 'inside', r.inside, 'before', r.before, 'cell', CAST(NULL AS {cell})),
        (a, c) -> CASE WHEN a.cell IS NOT NULL THEN a
          WHEN a.inside < c.n THEN named_struct('rank', a.rank, 'inside', a.inside, 'before', a.before, 'cell', CAST(c AS {cell}))
          ELSE named_struct('rank', a.rank, 'inside', a.inside - c.n, 'before', a.before + c.n, 'cell', CAST(NULL AS {cell})) END))"""
    hit = row.select(*keep, F.explode(F.expr(walk)).alias("h"))
    return hit.select(*keep, "h.rank", "h.inside", "h.before", "h.cell.p", F.col("h.cell.n").alias("equal"), "h.cell.lo", "h.cell.hi")


def select_ranks(rows: DataFrame, by: list[str], value: str, ranks: Column, weight: str | None = None, bounded: bool = False) -> DataFrame:
    """The values at wanted places of each group: by..., size, total, rank, value, before, equal.

    ``ranks`` is an array of places from 0, as an expression on ``by`` columns and ``size`` (rows of the group with a value);
    places outside the group are left out. ``total`` is the sum of ``weight`` over the group; ``before`` and ``equal`` count
    the rows below the value and at it. ``bounded`` states that the groups are few, so that cells may be broadcast unasked.
    """
    kind = dict(rows.dtypes)[value]
    total = F.col(weight) if weight else F.lit(0)
    held = rows.select(*by, F.col(value).alias("v"), total.alias("w"), ordered_bits(F.col(value), kind).alias("key")).where("key IS NOT NULL")
    wanted = F.transform(
        F.filter(F.array_distinct(ranks), lambda r: (r >= 0) & (r < F.col("size"))),
        lambda r: F.struct(r.cast("bigint").alias("rank"), r.cast("bigint").alias("inside"), F.lit(0).cast("bigint").alias("before")),
    )
    groups = saved(_cells(held, by, 64 - ROUND_BITS).withColumn("ranks", wanted))
    keys = [f"_{c}" for c in by]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    rounds = [saved(_found(groups, by, kind))]
    for shift in range(64 - 2 * ROUND_BITS, -1, -ROUND_BITS):
        open_ = rounds[-1].where("lo <> hi")
        if open_.isEmpty():
            break
        asked = open_.groupBy(*by, "p").agg(F.sort_array(F.collect_list(F.struct("rank", "inside", "before"))).alias("ranks"))
        asked = asked.select(*named, F.col("p").alias("_p"), "ranks")
        scopes = asked.drop("ranks")
        scopes = F.broadcast(scopes) if bounded or not by else sized(scopes)
        near = held.withColumn("_scope", F.shiftright("key", shift + ROUND_BITS)).join(scopes, same([*by, "_scope"], [*keys, "_p"]))
        cells = _cells(near, [*by, "_scope"], shift).select(*by, "_scope", "cells")
        rounds.append(saved(_found(cells.join(asked, same([*by, "_scope"], [*keys, "_p"])), by, kind)))
    found = reduce(DataFrame.unionByName, [r.where("lo = hi") for r in rounds])
    found = found.select(*by, "rank", F.col("lo").alias("value"), "before", "equal")
    sizes = groups.select(*named, "size", "total")
    whole = found.join(sizes, same(by, keys)) if by else attach(found, sizes)
    return whole.select(*by, "size", "total", "rank", "value", "before", "equal")
