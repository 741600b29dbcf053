"""Canonical text, typed columns, duplicate removal and group-median repair of sensor faults."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions import text
from kerbline.functions.quantiles import exact_quantiles
from kerbline.shared import attach, sized
from kerbline.sources.tables import CORRUPT

# Fixed values.
NO_HOLIDAY = "No Holiday"
NUMERIC = {"temp": "double", "rain_1h": "double", "snow_1h": "double", "clouds_all": "int", "traffic_volume": "bigint"}
REQUIRED_VALUES = ["temp", "rain_1h", "traffic_volume"]


@dataclass(frozen=True)
class OutlierRule:
    column: str
    is_fault: Callable[[Column], Column]
    reason: str


OUTLIER_RULES = [
    OutlierRule("temp", lambda c: c <= 0, "temperature was 0 Kelvin or lower"),
    OutlierRule("rain_1h", lambda c: c > 9000, "hourly rainfall exceeded 9,000 mm"),
]


def is_missing(column: str) -> Column:
    """Null, blank and the word None all count as missing."""
    stripped = text.strip(column)
    return F.col(column).isNull() | (stripped == "") | (stripped == "None")


def fill_missing_category(df: DataFrame, column: str = "holiday", label: str = NO_HOLIDAY) -> DataFrame:
    return df.withColumn(column, F.when(is_missing(column), label).otherwise(F.col(column)))


def canonical(column: str) -> Column:
    return {
        "holiday": text.strip,
        "weather_main": text.title,
        "weather_description": lambda c: F.lower(text.strip(c)),
    }[column](column)


def standardise_text(df: DataFrame) -> DataFrame:
    columns = ["holiday", "weather_main", "weather_description"]
    return df.withColumns({c: canonical(c) for c in columns})


def parse_timestamp(df: DataFrame, column: str = "date_time") -> DataFrame:
    return df.withColumn(column, text.timestamp(column))


def typed(df: DataFrame, column: str, target: str) -> Column:
    """A column as a number of the target type; what the type cannot hold, fractions of counts too, becomes null."""
    source = dict(df.dtypes)[column]
    if source == "string":
        value = text.number(column)
    elif source in ("float", "double"):
        value = F.nanvl(F.col(column), F.lit(None).cast("double"))
    else:
        return F.col(column).try_cast(target)
    if target not in ("float", "double"):
        value = F.when(value == F.floor(value), value)
    return value.try_cast(target)


def parse_numeric(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    columns = columns or NUMERIC
    return df.withColumns({c: typed(df, c, t) for c, t in columns.items()})


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with a value in every required column; unreadable numbers and NaN are null by now."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns or REQUIRED_VALUES]))


def apply_date_policy(df: DataFrame, policy: str = "drop", column: str = "date_time") -> DataFrame:
    """Rows whose timestamp is null: ``drop`` them, ``raise``, or keep only them (``quarantine``)."""
    bad = F.col(column).isNull()
    if policy == "drop":
        return df.where(~bad)
    if policy == "quarantine":
        return df.where(bad)
    if policy == "raise":
        invalid = df.agg(F.count_if(bad).alias("n")).first()["n"]
        if invalid:
            raise DataError(f"found {invalid} invalid {column} values")
        return df
    raise DataError(f"unknown date policy {policy!r}")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def impute_by_group_median(
    df: DataFrame, rules: list[OutlierRule], group: Column, bounded_groups: bool = False
) -> DataFrame:
    """Replace flagged values with the median of unflagged values of the same group.

    A group without any valid value takes the median over all groups. All rules and both levels
    come from one quantile query over the unflagged values.
    """
    columns = df.columns
    flagged = df.withColumn("_group", F.coalesce(group.cast("string"), F.lit("")))
    valid = flagged.select(
        F.explode(F.array(F.struct(F.col("_group").alias("level")), F.struct(F.lit(None).cast("string").alias("level")))).alias("g"),
        *[F.when(~F.coalesce(r.is_fault(F.col(r.column)), F.lit(False)), F.col(r.column)).alias(r.column) for r in rules],
    ).select("g.level", *[r.column for r in rules])
    medians = exact_quantiles(valid, [r.column for r in rules], [0.5], ["level"], bounded_groups)
    # The flag is an aggregate, and the join below null-safe, so that no filter is pushed into only
    # one use of the medians: both then share one computation.
    wide = medians.groupBy("level").agg(
        F.bool_and(F.col("level").isNull()).alias("is_overall"),
        *[F.max(F.when(F.col("feature") == r.column, F.col("q")[0])).alias(f"_m_{r.column}") for r in rules]
    )
    overall = wide.where("is_overall").select(*[F.col(f"_m_{r.column}").alias(f"_o_{r.column}") for r in rules])
    groups = wide.where("NOT is_overall").drop("is_overall")
    groups = F.broadcast(groups) if bounded_groups else sized(groups)
    repaired = attach(flagged.join(groups, flagged["_group"].eqNullSafe(groups["level"]), "left"), overall)
    fixes = {
        r.column: F.when(
            r.is_fault(F.col(r.column)), F.coalesce(F.col(f"_m_{r.column}"), F.col(f"_o_{r.column}"))
        ).otherwise(F.col(r.column))
        for r in rules
    }
    return repaired.withColumns(fixes).select(*columns)


def repair_outliers(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return impute_by_group_median(df, OUTLIER_RULES, F.month(ts), bounded_groups=True)


def clean(raw: DataFrame) -> DataFrame:
    """Canonicalise, type, drop incomplete rows and copies, repair sensor faults."""
    return (
        raw.transform(fill_missing_category)
        .transform(standardise_text)
        .transform(parse_timestamp)
        .transform(apply_date_policy)
        .transform(parse_numeric)
        .transform(drop_incomplete)
        .transform(drop_exact_duplicates)
        .transform(repair_outliers)
    )


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """Rows touched by every cleaning step as (step, column, rows_changed), with unreadable lines where the table keeps them."""
    texts = ["holiday", "weather_main", "weather_description"]
    parsed_ts = text.timestamp("date_time")
    numbers = {c: typed(raw, c, t) for c, t in NUMERIC.items()}
    incomplete = F.lit(False)
    for c in REQUIRED_VALUES:
        incomplete = incomplete | numbers[c].isNull()
    counts = {("fill_missing", "holiday"): F.col("_missing")}
    for c in texts:
        counts[("standardise", c)] = F.coalesce(F.col(c), F.lit("")) != F.coalesce(canonical(c), F.lit(""))
    counts[("drop_invalid_date", "date_time")] = parsed_ts.isNull()
    for c in NUMERIC:
        counts[("invalid_number", c)] = parsed_ts.isNotNull() & F.col(c).isNotNull() & numbers[c].isNull()
    counts[("drop_incomplete", "all")] = parsed_ts.isNotNull() & incomplete
    if CORRUPT in raw.columns:
        counts[("corrupt_line", "all")] = F.col(CORRUPT).isNotNull()
    entries = [
        F.struct(F.lit(s).alias("step"), F.lit(c).alias("column"), F.count_if(e).alias("rows_changed"))
        for (s, c), e in counts.items()
    ]
    flagged = raw.withColumn("_missing", is_missing("holiday")).transform(fill_missing_category)
    first = flagged.agg(F.array(*entries).alias("e")).select(F.inline("e"))

    ready = raw.transform(fill_missing_category).transform(standardise_text).transform(parse_timestamp)
    ready = ready.transform(apply_date_policy).transform(parse_numeric).transform(drop_incomplete)
    copies = ready.groupBy(*ready.columns).agg(F.count(F.lit(1)).alias("copies"))
    late = copies.agg(
        F.array(
            F.struct(
                F.lit("drop_duplicates").alias("step"),
                F.lit("all").alias("column"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_changed"),
            ),
            *[
                F.struct(
                    F.lit("impute").alias("step"),
                    F.lit(r.column).alias("column"),
                    F.count_if(r.is_fault(F.col(r.column))).alias("rows_changed"),
                )
                for r in OUTLIER_RULES
            ],
        ).alias("e")
    ).select(F.inline("e"))
    return first.unionByName(late)
