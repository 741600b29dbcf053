"""Experiment-run tables: append-only records and the latest run per model version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_records(
    source: DataFrame,
    run_id: Column,
    name: Column,
    tags: dict[str, Column],
    params: dict[str, Column],
    metrics: dict[str, Column],
    status: Column,
    start_time: Column,
) -> DataFrame:
    """One row per run with tags, params and metrics as maps."""

    def as_map(entries: dict[str, Column], dtype: str) -> Column:
        pairs = [x for k, v in entries.items() for x in (F.lit(k), v.cast(dtype))]
        return F.create_map(*pairs)

    return source.select(
        run_id.alias("run_id"),
        name.alias("run_name"),
        as_map(tags, "string").alias("tags"),
        as_map(params, "string").alias("params"),
        as_map(metrics, "double").alias("metrics"),
        status.alias("status"),
        start_time.alias("start_time"),
    )


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def latest_per_key(df: DataFrame, key: Column, newest: list[Column], name: str = "key") -> DataFrame:
    """Newest row per key; null keys are dropped. A max-by aggregate, so hot keys combine map-side."""
    row = F.struct(*df.columns)
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(newest)])
    picked = df.where(key.isNotNull()).groupBy(key.alias(name)).agg(F.max_by(row, order).alias("r"))
    return picked.select(name, "r.*")


def run_comparison(runs: DataFrame) -> DataFrame:
    """Latest run per model version with its headline fields, ordered by solution version."""
    latest = latest_per_key(runs, F.col("tags")["model_version"], [F.col("start_time"), F.col("run_id")], "Model_Version")
    return latest.select(
        F.col("tags")["solution_version"].alias("Solution_Version"),
        "Model_Version",
        F.col("tags")["candidate_status"].alias("Candidate_Status"),
        F.col("tags")["data_version"].alias("Data_Version"),
        F.col("run_name").alias("Run"),
        F.bround(F.col("metrics")["mae"], 4).alias("MAE"),
        F.bround(F.col("metrics")["r2"], 4).alias("R2"),
        F.col("params")["model_type"].alias("Model_Type"),
        F.col("params")["split_method"].alias("Split_Method"),
        F.col("status").alias("Status"),
    ).orderBy("Solution_Version", "Model_Version")
