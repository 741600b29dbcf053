import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline import DataError
from kerbline.functions import calendar, text
from kerbline.operators import describe, features, quality, stats


def volumes(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, traffic_volume bigint")


def test_quartiles_are_right_closed_and_keep_ties_together(spark):
    out = features.quartile_category(volumes(spark, [1, 2, 2, 2, 3, 4, 5, 6, 7])).orderBy("i")
    assert [r["congestion_quartile"] for r in out.collect()] == ["Low"] * 4 + ["Medium"] + ["High"] * 2 + ["Severe"] * 2


def test_repeated_quartile_edge_is_an_error(spark):
    with pytest.raises(Exception, match="distinct traffic_volume quartiles"):
        features.quartile_category(volumes(spark, [1, 1, 1, 1, 2])).collect()


def test_zscore_uses_population_spread_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "temp double, traffic_volume double")
    rows = features.zscore(df).orderBy("temp").collect()
    assert [r["temp_scaled"] for r in rows] == [-1.0, 1.0]
    assert {r["traffic_volume_scaled"] for r in rows} == {0.0}


def test_one_hot_round_trip(spark):
    df = spark.createDataFrame([("Rain",), ("Clear",), ("Fog",)], "weather_main string")
    coded = features.one_hot_encode(df, keep_source=True)
    assert features.flag_columns(coded) == ["weather_main_Clear", "weather_main_Fog", "weather_main_Rain"]
    assert features.one_hot_decode(coded).where("weather <> weather_main").count() == 0
    broken = coded.withColumn("weather_main_Fog", F.lit(1))
    with pytest.raises(DataError, match="2 rows"):
        quality.require_one_hot(broken, features.flag_columns(coded))


def test_vocabulary_limit(spark):
    df = spark.createDataFrame([(str(i),) for i in range(5)], "weather_main string")
    with pytest.raises(DataError):
        features.vocabulary(df, limit=4)


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 9, 30, 23),), (dt.datetime(2018, 10, 1, 0),)], "date_time timestamp_ntz")
    row = features.calendar_parts(df).transform(features.weekend_flag).orderBy("date_time").collect()
    assert [(r.hour, r.day_of_week, r.month, r.year, r.is_weekend) for r in row] == [(23, 6, 9, 2018, 1), (0, 0, 10, 2018, 0)]
    assert df.where(calendar.years_between("date_time", 2018, 2018)).count() == 2
    assert df.where(calendar.on_date("date_time", "2018-10-01")).count() == 1
    texts = df.select(text.hour_range(F.hour("date_time")).alias("t")).orderBy("t").collect()
    assert [r.t for r in texts] == ["00:00 to 01:00", "23:00 to 00:00"]


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2018, 9, 30, 23), 1, 2)], "date_time timestamp_ntz, a int, b int").write.parquet(path)
    df = spark.read.parquet(path).where(calendar.years_between("date_time", 2018, 2018)).select("date_time", "a")
    plan = df._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date_time" in plan and "LessThan(date_time" in plan
    assert "ReadSchema: struct<date_time:timestamp_ntz,a:int>" in plan


def test_lookup_arguments(spark):
    with pytest.raises(DataError):
        describe.parse_day("2013-2-30")
    with pytest.raises(DataError):
        describe.check_count(21)
    with pytest.raises(DataError):
        describe.check_count(0)


def test_busiest_hour_is_the_first_maximum_after_rounding(spark):
    rows = [(dt.datetime(2015, 1, 5, h), h, v) for h, v in [(7, 10), (8, 100), (8, 101), (9, 100)]]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, hour int, traffic_volume bigint")
    out = describe.date_hourly_summary(df, "2015-01-05")
    assert {r["busiest_hour"] for r in out.collect()} == {8}
    assert [r["average_traffic_volume"] for r in out.where("hour = 8").collect()] == [100]


def test_yearly_change_skips_a_missing_year_and_zero_total(spark):
    rows = [(dt.datetime(y, 1, 1), v) for y, v in [(2012, 10), (2014, 0), (2015, 5)]]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, traffic_volume bigint")
    out = [(r.year, r.absolute_change, r.percentage_change) for r in describe.yoy_change(df).collect()]
    assert out == [(2012, None, None), (2014, -10, -100.0), (2015, 5, None)]


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    out = {r["bin"]: r["records"] for r in stats.histogram(volumes(spark, [0, 0, 5, 10]), bins=5).collect()}
    assert out == {1: 2, 2: 0, 3: 1, 4: 0, 5: 1}
    flat = stats.histogram(volumes(spark, [4, 4]), bins=4)
    assert sum(r["records"] for r in flat.collect()) == 2


def test_skewness_correction(spark):
    pandas = pytest.importorskip("pandas")
    values = [1, 2, 2, 9, 30]
    assert stats.skewness_adjusted(volumes(spark, values)).first()[0] == pytest.approx(pandas.Series(values).skew())


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(100, "Clear", 280.0)], "traffic_volume bigint, weather string, temp double")
    assert stats.event_probabilities(df).first()["p_clear_given_congestion"] is None
    assert stats.odds_ratio(df).first()["odds_ratio"] is None
