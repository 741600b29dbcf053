"""Schema and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions import text
from kerbline.functions.quantiles import exact_quantiles
from kerbline.shared import attach

# Fixed values.
WEATHER = [
    "Clear", "Clouds", "Drizzle", "Fog", "Haze", "Mist",
    "Rain", "Smoke", "Snow", "Squall", "Thunderstorm",
]


def schema_differences(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    have = set(df.schema.fieldNames())
    return sorted(set(expected) - have), sorted(have - set(expected))


def require_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    missing, _ = schema_differences(df, expected)
    if missing:
        raise DataError(f"missing expected columns: {missing}")
    return df


def schema_check(df: DataFrame, expected: list[str]) -> DataFrame:
    """One row per finding, (check, column, level), with the number of rows it concerns."""
    missing, unexpected = schema_differences(df, expected)
    findings = [("missing", c, "error") for c in missing] + [("unexpected", c, "warning") for c in unexpected]
    findings = findings or [("passed", "", "info")]
    rows = F.array(
        *[F.struct(F.lit(k).alias("check"), F.lit(c).alias("column"), F.lit(v).alias("level")) for k, c, v in findings]
    )
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(rows))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, null count and the table's row count."""
    measures = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count_if(F.col(f.name).isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def duplicate_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """Surplus copies of fully equal rows; 0 when there are none."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("exact_duplicate_rows"))


def year_coverage(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("recorded_hours"),
        F.min(ts).alias("first_record"),
        F.max(ts).alias("last_record"),
    )


def date_validity(df: DataFrame, column: str = "date_time") -> DataFrame:
    bad = text.timestamp(column).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("invalid_dates"),
        F.count_if(~bad).alias("kept_rows"),
    )


def numeric_validity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, values that were present but are not numbers."""
    measures = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNotNull() & text.number(c).isNull()).alias("invalid_values"),
            F.count_if(F.col(c).isNull()).alias("missing_values"),
        )
        for c in columns
    ]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    measures = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in columns]
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def null_gate(df: DataFrame, columns: list[str]) -> DataFrame:
    """Return the table unchanged, or fail with the null count of every bad column."""
    bad = {r["column"]: r["nulls"] for r in null_counts(df, columns).where("nulls > 0").collect()}
    if bad:
        raise DataError(f"null or non-numeric values in monitored columns: {bad}")
    return df


def one_hot_check(df: DataFrame, flags: list[str]) -> DataFrame:
    total = sum((F.col(c) for c in flags[1:]), F.col(flags[0]))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(total, F.lit(0)) != 1).alias("invalid_rows"),
    )


def require_one_hot(df: DataFrame, flags: list[str]) -> DataFrame:
    if not flags:
        raise DataError("no one-hot columns were found")
    invalid = one_hot_check(df, flags).first()["invalid_rows"]
    if invalid:
        raise DataError(f"{invalid} rows without exactly one category")
    return df


def request_problems(categories: list[str] | None = None) -> Column:
    """Array of reasons why a scoring request is out of contract; empty when it is valid."""
    allowed = categories or WEATHER

    def outside(column: str, low: float, high: float | None = None) -> Column:
        bad = F.col(column) < low
        if high is not None:
            bad = bad | (F.col(column) > high)
        return F.col(column).isNull() | F.isnan(F.col(column).cast("double")) | bad

    checks = [
        (F.col("date_time").isNull(), "date_time missing"),
        (outside("temp", 200, 350), "temp outside 200..350"),
        (outside("rain_1h", 0), "rain_1h below 0"),
        (outside("snow_1h", 0), "snow_1h below 0"),
        (outside("clouds_all", 0, 100), "clouds_all outside 0..100"),
        (F.col("weather_main").isNull() | ~F.col("weather_main").isin(allowed), "weather_main unknown"),
    ]
    return F.filter(F.array(*[F.when(bad, F.lit(why)) for bad, why in checks]), lambda x: x.isNotNull())


def with_request_defaults(df: DataFrame) -> DataFrame:
    """Absent rain and snow are zero; an absent holiday flag is false."""
    columns = df.columns
    for c in ["rain_1h", "snow_1h"]:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)) if c in columns else F.lit(0.0))
    flag = F.coalesce(F.col("is_holiday").cast("boolean"), F.lit(False)) if "is_holiday" in columns else F.lit(False)
    return df.withColumn("is_holiday", flag)


def range_quarantine(df: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Add ``reasons`` and ``is_valid``; callers split on ``is_valid``."""
    checked = with_request_defaults(df).withColumn("reasons", request_problems(categories))
    return checked.withColumn("is_valid", F.size("reasons") == 0)


def median_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls with the exact median of the column."""
    medians = exact_quantiles(df, columns, [0.5])
    wide = medians.agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[0])).alias(f"_m_{c}") for c in columns])
    filled = attach(df, wide)
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in columns}).select(*df.columns)
