"""Grouped descriptive queries, top-k lists and result sentences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions import calendar, text
from kerbline.functions.quantiles import exact_quantiles
from kerbline.shared import attach


def annual_totals(df: DataFrame, first: int = 2012, last: int = 2017, ts: str = "date_time", measure: str = "traffic_volume") -> DataFrame:
    return (
        df.where(calendar.years_between(ts, first, last))
        .groupBy(F.year(ts).alias("year"))
        .agg(
            F.count(F.lit(1)).alias("recorded_hours"),
            F.sum(measure).alias("total_traffic_volume"),
            F.avg(measure).alias("average_hourly_volume"),
        )
    )


def yoy_change(df: DataFrame, first: int = 2012, last: int = 2017, ts: str = "date_time", measure: str = "traffic_volume") -> DataFrame:
    """Totals per year with the change against the previous year present."""
    previous = F.lag("total_traffic_volume").over(Window.orderBy("year"))
    change = F.col("total_traffic_volume") - F.col("previous")
    return (
        annual_totals(df, first, last, ts, measure)
        .withColumn("previous", previous)
        .select(
            "year",
            "recorded_hours",
            "total_traffic_volume",
            F.round("average_hourly_volume", 2).alias("average_hourly_volume"),
            change.alias("absolute_change"),
            F.round(F.try_divide(F.lit(100.0) * change, F.col("previous").cast("double")), 2).alias("percentage_change"),
        )
        .orderBy("year")
    )


def holiday_comparison(df: DataFrame, holidays: list[str], first: int = 2015, last: int = 2017) -> DataFrame:
    once = (
        df.where(F.col("holiday").isin(holidays) & calendar.years_between("date_time", first, last))
        .select("date_time", "holiday", "temp", "traffic_volume")
        .distinct()
    )
    return (
        once.groupBy(F.year("date_time").alias("year"), "holiday")
        .agg(
            F.count(F.lit(1)).alias("unique_observations"),
            F.round(F.avg("temp"), 2).alias("average_temperature_kelvin"),
            F.round(F.avg(F.col("temp") - 273.15), 2).alias("average_temperature_celsius"),
            F.round(F.avg("traffic_volume"), 2).alias("average_traffic_volume"),
        )
        .orderBy("holiday", "year")
    )


def hourly_by_daytype(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    return df.groupBy("hour", "is_weekend").agg(F.avg(measure).alias("average_traffic_volume"))


def hourly_pivot(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    table = df.groupBy("hour").pivot("is_weekend", [0, 1]).agg(F.avg(measure))
    return table.withColumnsRenamed({"0": "weekday", "1": "weekend"})


def hourly_peaks(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    """Weekday morning and evening peaks and the weekend plateau, with display rounding."""
    hourly = hourly_by_daytype(df, measure)
    value, weekday, weekend = F.col("average_traffic_volume"), F.col("is_weekend") == 0, F.col("is_weekend") == 1

    def peak(low: int, high: int) -> tuple[Column, Column]:
        chosen = F.when(weekday & F.col("hour").between(low, high), F.struct(value.alias("v"), -F.col("hour")))
        hour = F.max_by(F.when(chosen.isNotNull(), F.col("hour")), chosen)
        return hour, F.max(F.when(chosen.isNotNull(), value))

    (morning_hour, morning), (evening_hour, evening) = peak(5, 11), peak(12, 20)
    plateau = F.avg(F.when(weekend & F.col("hour").between(12, 16), value))
    return hourly.agg(
        morning_hour.alias("weekday_morning_hour"),
        morning.alias("weekday_morning_value"),
        evening_hour.alias("weekday_evening_hour"),
        evening.alias("weekday_evening_value"),
        plateau.alias("weekend_plateau_value"),
    ).select(
        "*",
        F.bround("weekday_morning_value", -1).alias("morning_display"),
        F.bround("weekday_evening_value", -1).alias("evening_display"),
        (F.bround(F.col("weekend_plateau_value") / 50, 0) * 50).alias("weekend_display"),
    )


def weather_means(df: DataFrame, category: str = "weather", measure: str = "traffic_volume") -> DataFrame:
    return df.groupBy(category).agg(F.avg(measure).alias("mean"), F.count(measure).alias("count"))


def weather_extremes(df: DataFrame, category: str = "weather", measure: str = "traffic_volume") -> DataFrame:
    """Best and worst category, their difference and the evidence behind the worst."""
    means = weather_means(df, category, measure)
    worst = F.struct(F.col("mean").alias("m"), F.col(category).alias("c"))
    best = F.struct((-F.col("mean")).alias("m"), F.col(category).alias("c"))
    return means.agg(
        F.min_by(category, best).alias("highest"),
        F.min_by(category, worst).alias("lowest"),
        (F.max("mean") - F.min("mean")).alias("difference"),
        F.min_by("count", worst).alias("lowest_count"),
    )


def parse_day(day: str) -> str:
    """Strict YYYY-MM-DD."""
    try:
        return dt.datetime.strptime(day.strip(), "%Y-%m-%d").date().isoformat()
    except ValueError as error:
        raise DataError("enter the date in YYYY-MM-DD format") from error


def date_lookup_filter(df: DataFrame, day: str, ts: str = "date_time") -> DataFrame:
    return df.where(calendar.on_date(ts, parse_day(day)))


def date_hourly_summary(df: DataFrame, day: str, measure: str = "traffic_volume") -> DataFrame:
    """Rounded mean per hour of one date; the busiest hour is the first maximum of the rounded means."""
    hours = (
        date_lookup_filter(df, day)
        .groupBy("hour")
        .agg(F.bround(F.avg(measure), 0).cast("bigint").alias("average_traffic_volume"))
    )
    first = F.max_by("hour", F.struct(F.col("average_traffic_volume"), -F.col("hour"))).over(Window.partitionBy())
    return hours.withColumn("busiest_hour", first).withColumn("is_busiest", F.col("hour") == F.col("busiest_hour"))


def daytype_summary(df: DataFrame, measure: str = "traffic_volume") -> DataFrame:
    """Rounded mean, median and count per day type, and weekday minus weekend."""
    typed = df.select(calendar.day_type().alias("day_type"), measure)
    stats = exact_quantiles(typed, [measure], [0.5], ["day_type"], bounded_groups=True)
    rows = stats.select(
        "day_type",
        F.bround("mean", 0).cast("bigint").alias("mean"),
        F.bround(F.col("q")[0], 0).cast("bigint").alias("median"),
        F.col("n").alias("count"),
    )
    whole = Window.partitionBy()
    weekday = F.max(F.when(F.col("day_type") == "Weekday", F.col("mean"))).over(whole)
    weekend = F.max(F.when(F.col("day_type") == "Weekend", F.col("mean"))).over(whole)
    return rows.withColumn("weekday_minus_weekend", weekday - weekend)


def kpi(df: DataFrame, filters: Column | None = None, measure: str = "traffic_volume") -> DataFrame:
    chosen = df if filters is None else df.where(filters)
    return chosen.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(measure).alias("total_volume"),
        F.avg(measure).alias("average_volume"),
        F.max(measure).alias("peak_volume"),
    )


def daily_trend(df: DataFrame, ts: str = "date_time", measure: str = "traffic_volume") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.sum(measure).alias("total_volume"), F.avg(measure).alias("average_volume")
    )


def temperature_profile(df: DataFrame, width: float = 5.0, measure: str = "traffic_volume") -> DataFrame:
    return df.groupBy((F.floor(F.col("temp") / width) * width).alias("temp_bin")).agg(
        F.avg(measure).alias("average_volume"), F.count(F.lit(1)).alias("records")
    )


def label_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("records"))
    return share_of_total(counts, "records", "percentage").withColumn("percentage", F.round("percentage", 2))


def share_of_total(groups: DataFrame, count: str = "records", name: str = "record_percentage") -> DataFrame:
    """Percentage of the grand total; the total is one row, not a global window."""
    total = groups.agg(F.sum(count).cast("double").alias("_total"))
    return attach(groups, total).withColumn(name, F.col(count) / F.col("_total") * 100).drop("_total")


def check_count(n: int, low: int = 1, high: int = 20) -> int:
    if not isinstance(n, int) or isinstance(n, bool) or not low <= n <= high:
        raise DataError(f"enter a whole number between {low} and {high}")
    return n


def top_k_measure(df: DataFrame, n: int, ties: list[str], measure: str = "traffic_volume") -> DataFrame:
    check_count(n)
    return (
        df.orderBy(F.col(measure).desc(), *ties)
        .limit(n)
        .select(F.date_format("date_time", "yyyy-MM-dd HH:mm").alias("date_time"), measure, "congestion_quartile")
    )


def top_n_per_group(groups: DataFrame, partition: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group of an already aggregated table."""
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return groups.withColumn("rank", rank).where(F.col("rank") <= n)


def quiet_hours(df: DataFrame, n: int = 3) -> DataFrame:
    hourly = hourly_by_daytype(df).withColumn("day_type", calendar.day_type())
    ranked = top_n_per_group(hourly, ["day_type"], [F.col("average_traffic_volume"), F.col("hour")], n)
    return ranked.select(
        "day_type",
        "rank",
        text.hour_mark(F.col("hour")).alias("recommended_time"),
        F.bround("average_traffic_volume", 0).cast("bigint").alias("average_traffic_volume"),
    )


def whole_number(value: Column) -> Column:
    """Half-even rounding with thousands separators."""
    return F.regexp_replace(F.bround(value, 0).cast("bigint").cast("string"), r"(?<=\d)(?=(\d{3})+$)", ",")


def narrative_text(df: DataFrame, distribution: DataFrame) -> DataFrame:
    """Three result sentences: hourly peaks, distribution shape and weather comparison.

    ``distribution`` is the one-row result of ``stats.distribution_shape``.
    """
    peaks = hourly_peaks(df).select(
        F.lit(1).alias("line_no"),
        F.format_string(
            "Weekday traffic peaks around %02d:00 (~%s) and again at %02d:00 (~%s); "
            "weekend traffic holds a plateau of about %s from midday to late afternoon.",
            F.col("weekday_morning_hour"),
            whole_number(F.col("morning_display")),
            F.col("weekday_evening_hour"),
            whole_number(F.col("evening_display")),
            whole_number(F.col("weekend_display")),
        ).alias("line"),
    )
    shape = distribution.select(
        F.lit(2).alias("line_no"),
        F.format_string(
            "Beside the low-traffic readings, volumes concentrate between %s and %s; "
            "the mean is %s, the median %s and the skewness %s.",
            whole_number(F.col("mode_low")),
            whole_number(F.col("mode_high")),
            whole_number(F.col("mean")),
            whole_number(F.col("median")),
            F.format_string("%.3f", F.bround("skewness", 3)),
        ).alias("line"),
    )
    weather = weather_extremes(df).select(
        F.lit(3).alias("line_no"),
        F.format_string(
            "%s has the highest average traffic and %s the lowest, a difference of about %s vehicles; "
            "the lowest rests on %d records.",
            F.col("highest"),
            F.col("lowest"),
            whole_number(F.col("difference")),
            F.col("lowest_count"),
        ).alias("line"),
    )
    return peaks.unionByName(shape).unionByName(weather)
