"""Exact linear-interpolated quantiles of groups, from the values at neighbouring ranks (``selection``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions.selection import select_ranks


def long_form(df: DataFrame, values: list[str], by: list[str]) -> DataFrame:
    """One row per (row, feature) with a non-null double value ``v``."""
    if len(values) == 1:
        out = df.select(*by, F.lit(values[0]).alias("feature"), F.col(values[0]).cast("double").alias("v"))
    else:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in values]
        )
        out = df.select(*by, F.inline(pairs))
    return out.where(F.col("v").isNotNull() & ~F.isnan("v"))


def exact_quantiles(
    df: DataFrame,
    values: list[str],
    probabilities: list[float],
    by: list[str] | None = None,
    bounded_groups: bool = False,
) -> DataFrame:
    """Rows (by..., feature, n, mean, q) where ``q`` holds one exact quantile per probability.

    ``bounded_groups`` states that the grouping columns have a fixed small domain (months, hours);
    otherwise the number of groups is counted before anything is broadcast.
    """
    keys = [*(by or []), "feature"]
    rows = long_form(df, values, by or [])
    steps = ", ".join(f"{float(p)!r}D" for p in probabilities)
    ranks = F.expr(f"flatten(transform(array({steps}), p -> array(floor((size - 1) * p), least(floor((size - 1) * p) + 1, size - 1))))")
    found = select_ranks(rows, keys, "v", ranks, "v", bounded_groups or not by)
    held = found.groupBy(*keys).agg(
        F.first("size").alias("n"),
        (F.first("total") / F.first("size")).alias("mean"),
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"),
    )
    q = f"""transform(array({steps}), p -> at[CAST(floor((n - 1) * p) AS BIGINT)]
        + (at[CAST(least(floor((n - 1) * p) + 1, n - 1) AS BIGINT)] - at[CAST(floor((n - 1) * p) AS BIGINT)]) * ((n - 1) * p - floor((n - 1) * p)))"""
    return held.select(*keys, "n", "mean", F.expr(q).alias("q"))
