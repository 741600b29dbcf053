"""Hourly traffic observations derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = [
    "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
    "weather_main", "weather_description", "date_time", "traffic_volume",
]
KEY = ["event_id", "weather_main"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_raw(events: DataFrame) -> DataFrame:
    """Raw observations: padded names, mixed case, sensor faults, copies and second weather rows."""
    event = F.col("event_id")
    timed = events.select(
        event,
        "user_id",
        "event_type",
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
        F.expr("timestampadd(HOUR, cast((event_id * 5) % 43824 as int), timestamp_ntz'2012-10-02 00:00:00')").alias("dt"),
    ).select("*", F.hour("dt").alias("h"), F.month("dt").alias("m"), F.dayofmonth("dt").alias("d"), F.weekday("dt").alias("wd"))
    weather = (
        F.when(event % 1000 == 3, "Squall")
        .when(F.col("event_type") == "click", "Clear")
        .when(F.col("event_type") == "view", "Clouds")
        .when(F.col("event_type") == "purchase", "Rain")
        .when(F.col("event_type") == "error", "Mist")
        .when(F.col("m").isin(12, 1, 2), "Snow")
        .otherwise("Drizzle")
    )
    h, m, d, wd, k, w = (F.col(c) for c in ["h", "m", "d", "wd", "k", "w"])
    base = (
        F.when((wd < 5) & h.isin(7, 8, 9, 15, 16, 17, 18), 4500)
        .when((wd < 5) & h.between(6, 20), 3200)
        .when(wd < 5, 500)
        .when(h.between(10, 18), 3300)
        .otherwise(700)
    )
    copies = F.filter(
        F.array(F.lit("one"), F.when(event % 500 == 1, "copy"), F.when(event % 9 == 4, "haze")),
        lambda x: x.isNotNull(),
    )
    # The values travel inside the exploded entries, so later filters are not copied below the explode.
    values = ["user_id", "value", "k", "dt", "h", "m", "d", "wd", "w"]
    rows = timed.withColumn("w", weather).select(
        event, F.inline(F.transform(copies, lambda kind: F.struct(kind.alias("kind"), *values)))
    )
    haze = F.col("kind") == "haze"
    return rows.select(
        event,
        F.when((m == 1) & (d == 1), "New Years Day")
        .when((m == 9) & (d <= 7) & (wd == 0), " Labor Day ")
        .when((m == 7) & (d == 4), "Independence Day")
        .alias("holiday"),
        F.when(event % 997 == 5, 0.0).otherwise((255 + (F.col("user_id") * 7 + m * 3) % 50).cast("double")).alias("temp"),
        F.when(event % 4001 == 7, 9831.3).when(w == "Rain", k / 20).otherwise(0.0).alias("rain_1h"),
        F.when(w == "Snow", k / 200).otherwise(0.0).alias("snow_1h"),
        k.alias("clouds_all"),
        F.when(haze, "Haze")
        .when(event % 11 == 0, F.upper(w))
        .when(event % 13 == 0, F.concat(F.lit(" "), w))
        .otherwise(w)
        .alias("weather_main"),
        F.when(haze, "haze")
        .when((w == "Clear") & (event % 7 == 0), "Sky is Clear")
        .when(w == "Clear", "sky is clear")
        .otherwise(F.concat(F.lit("light "), F.lower(w)))
        .alias("weather_description"),
        F.col("dt").alias("date_time"),
        F.least(F.lit(7280), F.floor(base + F.col("value") * 8)).cast("bigint").alias("traffic_volume"),
    )


def traffic_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_raw(read(spark, sf_dir, "events"))


def as_text(raw: DataFrame) -> DataFrame:
    """The raw rows as an all-text landing with unreadable numbers, dates and missing-value words."""
    event = F.col("event_id")
    return raw.select(
        event,
        F.when(event % 19 == 0, "").when(event % 23 == 0, "None").otherwise(F.col("holiday")).alias("holiday"),
        F.when(event % 83 == 5, "n/a").otherwise(F.col("temp").cast("string")).alias("temp"),
        F.when(event % 89 == 7, "trace").otherwise(F.col("rain_1h").cast("string")).alias("rain_1h"),
        F.when(event % 73 != 1, F.col("snow_1h").cast("string")).alias("snow_1h"),
        F.when(event % 79 == 2, "unknown").otherwise(F.col("clouds_all").cast("string")).alias("clouds_all"),
        "weather_main",
        "weather_description",
        F.when(event % 101 == 9, "not a date")
        .otherwise(F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))
        .alias("date_time"),
        F.when(event % 97 == 11, "err").otherwise(F.col("traffic_volume").cast("string")).alias("traffic_volume"),
    )


def traffic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(traffic_raw(spark, sf_dir))
