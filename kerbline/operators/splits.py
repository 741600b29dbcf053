"""Reproducible splits and samples; membership depends on row keys only, never on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.ranks import HASH_SPAN, first_rows, row_hash
from kerbline.functions.selection import select_ranks
from kerbline.shared import saved, sized


def random_split(df: DataFrame, keys: list[str], train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``is_train`` by key hash; sizes follow the share within sampling error."""
    return df.withColumn("is_train", row_hash(*keys, seed=seed) < int(train_share * HASH_SPAN))


def stratified_split(df: DataFrame, label: str, keys: list[str], train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``is_train`` so that each class keeps floor(share * n) of its rows in train, in order of key hash and keys.

    The cuts of all classes are found together from counts of hashes, however many classes there are, and a class of any
    size stays spread out.
    """
    hashed = df.withColumn("_h", row_hash(*keys, seed=seed))
    last = F.floor(F.col("size") * F.lit(train_share)).cast("bigint") - 1
    cuts = select_ranks(hashed, [label], "_h", F.array(last)).select(
        F.col(label).alias("_label"), F.col("value").alias("_cut"), (F.col("rank") + 1 - F.col("before")).alias("_need"), F.col("equal").alias("_equal")
    )
    cuts = saved(cuts)
    # Different keys of one hash at a cut are told apart by the keys themselves.
    tied = hashed.join(sized(cuts.where("_need < _equal")), F.col(label).eqNullSafe(F.col("_label")) & (F.col("_h") == F.col("_cut")))
    counts = tied.groupBy("_label", "_need", F.struct(*keys).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    places = counts.groupBy(F.col("_label").alias("_tied"), "_need").agg(F.sort_array(F.collect_list(F.struct("k", "n"))).alias("c"))
    within = "filter(c, (x, i) -> aggregate(slice(c, 1, i + 1), 0L, (a, y) -> a + y.n) <= _need)"
    split = F.raise_error(F.lit(f"keys {keys} do not identify a row at the cut of a class"))
    whole = F.expr(f"aggregate({within}, 0L, (a, y) -> a + y.n)") == F.col("_need")
    limits = places.select("_tied", F.when(whole, F.element_at(F.expr(within), -1)["k"]).otherwise(split).alias("_limit"))
    marked = hashed.join(sized(cuts), F.col(label).eqNullSafe(F.col("_label")), "left")
    marked = marked.join(sized(limits), (F.col("_need") < F.col("_equal")) & F.col("_label").eqNullSafe(F.col("_tied")), "left")
    at_cut = (F.col("_need") == F.col("_equal")) | (F.struct(*keys) <= F.col("_limit"))
    train = (F.col("_h") < F.col("_cut")) | ((F.col("_h") == F.col("_cut")) & at_cut)
    return marked.select(*df.columns, F.coalesce(train, F.lit(False)).alias("is_train"))


def chronological_cut(df: DataFrame, order: list[str], train_share: float = 0.8, total: int | None = None) -> Column:
    """Predicate of the first floor(share * n) rows in time order; ``order`` must identify a row."""
    total = df.count() if total is None else total
    return first_rows(df.select(*order), order, math.floor(total * train_share), total)


def chronological_split(df: DataFrame, order: list[str], train_share: float = 0.8) -> DataFrame:
    return df.withColumn("is_train", chronological_cut(df, order, train_share))


def fixed_size_sample(df: DataFrame, keys: list[str], n: int = 5000, seed: int = 42, total: int | None = None) -> DataFrame:
    """min(n, N) rows without replacement: those with the smallest key hashes.

    A hash threshold slightly above n/N is checked by counting and widened until it holds n rows,
    so the final sort sees little more than n rows however large the table is.
    """
    total = df.count() if total is None else total
    if n >= total:
        return df
    hashed = df.withColumn("_h", row_hash(*keys, seed=seed))
    share = (n + 6 * math.sqrt(n) + 50) / total
    while share < 1 and hashed.where(F.col("_h") < int(share * HASH_SPAN)).count() < n:
        share *= 2
    near = hashed if share >= 1 else hashed.where(F.col("_h") < int(share * HASH_SPAN))
    return near.orderBy("_h", *keys).limit(n).drop("_h")
