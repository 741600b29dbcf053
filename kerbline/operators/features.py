"""Calendar, indicator, quartile, scaled and one-hot features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions import calendar
from kerbline.functions.quantiles import exact_quantiles
from kerbline.operators.cleaning import NO_HOLIDAY
from kerbline.operators.quality import WEATHER
from kerbline.shared import attach

# Fixed values.
PREFIX = "weather_main_"
QUARTILE_LABELS = ["Low", "Medium", "High", "Severe"]
ADVERSE = ["Thunderstorm", "Snow", "Squall", "Fog", "Mist", "Haze", "Smoke"]
QUARTILE_STEPS = [0.0, 0.25, 0.5, 0.75, 1.0]
MAX_CATEGORIES = 1000


def calendar_parts(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumns({"hour": F.hour(ts), "day_of_week": F.weekday(ts), "month": F.month(ts), "year": F.year(ts)})


def weekend_flag(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumn("is_weekend", calendar.weekend(ts))


def cyclical_encode(df: DataFrame, ts: str = "date_time", weekday: bool = True) -> DataFrame:
    hour_sin, hour_cos = calendar.cyclical(F.hour(ts), 24)
    month_sin, month_cos = calendar.cyclical(F.month(ts), 12, offset=1)
    out = {"hour_sin": hour_sin, "hour_cos": hour_cos, "month_sin": month_sin, "month_cos": month_cos}
    if weekday:
        out["day_of_week_sin"], out["day_of_week_cos"] = calendar.cyclical(F.weekday(ts), 7)
    return df.withColumns(out)


def indicator_flags(df: DataFrame, ts: str = "date_time") -> DataFrame:
    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    return df.withColumns(
        {
            "is_holiday": flag(F.coalesce(F.col("holiday") != NO_HOLIDAY, F.lit(True))),
            "is_rainy": flag(F.col("rain_1h") > 0),
            "is_snowy": flag(F.col("snow_1h") > 0),
            "is_peak_hour": flag(F.hour(ts).isin(calendar.PEAK_HOURS)),
        }
    )


def quartile_edges(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    """One row (minimum, q1, q2, q3, maximum)."""
    q = F.col("q")
    return exact_quantiles(df, [measure], QUARTILE_STEPS).select(
        q[0].alias("minimum"), q[1].alias("q1"), q[2].alias("q2"), q[3].alias("q3"), q[4].alias("maximum")
    )


def quartile_label(measure: Column, edges: list[Column]) -> Column:
    """Right-closed quartile label with the minimum included."""
    q1, q2, q3 = edges
    low, medium, high, severe = QUARTILE_LABELS
    return (
        F.when(measure <= q1, low).when(measure <= q2, medium).when(measure <= q3, high).when(measure > q3, severe)
    )


def quartile_category(df: DataFrame, measure: str = "traffic_volume", name: str = "congestion_quartile") -> DataFrame:
    """Label each row by exact quartile; repeated edges are an error, not a merge."""
    edges = quartile_edges(df, measure)
    distinct = (
        (F.col("minimum") < F.col("q1"))
        & (F.col("q1") < F.col("q2"))
        & (F.col("q2") < F.col("q3"))
        & (F.col("q3") < F.col("maximum"))
    )
    problem = F.raise_error(F.lit(f"unable to create four distinct {measure} quartiles")).cast("string")
    label = F.when(distinct, quartile_label(F.col(measure), [F.col("q1"), F.col("q2"), F.col("q3")])).otherwise(problem)
    return attach(df, edges).withColumn(name, label).select(*df.columns, name)


def scale_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (mean_<c>, scale_<c>): population deviation, 1 where it is zero."""
    measures = []
    for c in columns:
        spread = F.stddev_pop(c)
        measures += [F.avg(c).alias(f"mean_{c}"), F.when(spread == 0, 1.0).otherwise(spread).alias(f"scale_{c}")]
    return df.agg(*measures)


def zscore(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or ["temp", "traffic_volume"]
    stats = scale_statistics(df, columns)
    scaled = {f"{c}_scaled": (F.col(c) - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in columns}
    return attach(df, stats).withColumns(scaled).select(*df.columns, *scaled)


def vocabulary(df: DataFrame, column: str = "weather_main", limit: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct categories; a column with more than ``limit`` of them is refused."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise DataError(f"{column} has more than {limit} categories")
    return sorted(r[0] for r in found)


def one_hot_encode(
    df: DataFrame, column: str = "weather_main", categories: list[str] | None = None, keep_source: bool = False
) -> DataFrame:
    categories = categories or vocabulary(df, column)
    flags = [
        F.coalesce((F.col(column) == c).cast("int"), F.lit(0)).alias(f"{column}_{c}") for c in sorted(categories)
    ]
    kept = [c for c in df.columns if keep_source or c != column]
    return df.select(*kept, *flags)


def flag_columns(df: DataFrame, prefix: str = PREFIX) -> list[str]:
    flags = sorted(c for c in df.columns if c.startswith(prefix))
    if not flags:
        raise DataError(f"no columns start with {prefix}")
    return flags


def decoded(flags: list[str], prefix: str = PREFIX) -> Column:
    """Label of the first set flag; with none set, the first flag wins as in an arg-max."""
    hits = [F.when(F.col(c) == 1, F.lit(c[len(prefix):])) for c in flags]
    return F.coalesce(*hits, F.lit(flags[0][len(prefix):]))


def one_hot_decode(df: DataFrame, name: str = "weather", prefix: str = PREFIX) -> DataFrame:
    return df.withColumn(name, decoded(flag_columns(df, prefix), prefix))


def adverse_weather_flag(df: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """1 when any adverse-weather flag present in the table is set."""
    present = [F.col(prefix + c) for c in ADVERSE if prefix + c in df.columns]
    if not present:
        return df.withColumn("adverse_weather", F.lit(0))
    return df.withColumn("adverse_weather", F.greatest(*present, F.lit(0)))


def proxy_risk_label(df: DataFrame) -> DataFrame:
    risky = F.col("congestion_quartile").isin("High", "Severe") & (F.col("adverse_weather") == 1)
    return df.withColumn("risk_label", F.coalesce(risky, F.lit(False)).cast("int"))


def shift_transform(df: DataFrame) -> DataFrame:
    """Deliberate drift for alert tests; the constants are fixed values."""
    return df.withColumns(
        {
            "traffic_volume": F.greatest(F.col("traffic_volume") * 1.35 + 500, F.lit(0.0)),
            "temp": F.col("temp") + 12,
            "clouds_all": F.least(F.greatest(F.col("clouds_all") + 30, F.lit(0)), F.lit(100)),
            "rain_1h": F.greatest(F.col("rain_1h") + 1, F.lit(0.0)),
        }
    )


def engineer(
    cleaned: DataFrame, categories: list[str] | None = None, keep_source: bool = False
) -> DataFrame:
    """All features in a fixed order; weather flags default to the serving vocabulary."""
    timed = calendar_parts(cleaned).drop("year").transform(weekend_flag)
    return (
        timed.transform(lambda d: cyclical_encode(d, weekday=False))
        .transform(indicator_flags)
        .transform(quartile_category)
        .transform(zscore)
        .transform(lambda d: one_hot_encode(d, categories=categories or WEATHER, keep_source=keep_source))
    )


def model_columns() -> list[str]:
    """The 23 model inputs in serving order."""
    # Fixed values.
    base = [
        "temp", "rain_1h", "snow_1h", "clouds_all", "is_holiday", "is_weekend",
        "hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
    ]
    return base + [PREFIX + c for c in WEATHER]


