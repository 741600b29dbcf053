import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline import DataError
from kerbline.functions import text
from kerbline.functions.quantiles import exact_quantiles
from kerbline.operators import cleaning, quality
from kerbline.sources import tables
from kerbline.sources.fixture import RAW_COLUMNS


def one(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_strip_title_and_missing(spark):
    df = spark.createDataFrame(
        [(1, "  Labor Day\t"), (2, None), (3, "  "), (4, "None"), (5, "No Holiday")], "i int, holiday string"
    )
    filled = cleaning.fill_missing_category(df).withColumn("holiday", text.strip("holiday")).orderBy("i")
    assert [r.holiday for r in filled.collect()] == ["Labor Day", "No Holiday", "No Holiday", "No Holiday", "No Holiday"]
    words = spark.createDataFrame([(" cLEAR\n",), ("rain/snow",), ("o'NEIL  day 2nd",), ("",), (None,)], "w string")
    assert one(words.select(text.title("w").alias("w")), "w") == [("Clear",), ("Rain/Snow",), ("O'Neil  Day 2Nd",), ("",), (None,)]


def test_fractions_of_counts_are_null_and_audited(spark):
    columns = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    row = dict(temp="280", rain_1h="0", snow_1h="0", weather_main="Clear", weather_description="x", date_time="2015-01-01 03:00:00")
    rows = [{**row, "clouds_all": c, "traffic_volume": v} for c, v in [("12.7", "40.0"), ("12", "40.9")]]
    raw = spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], columns)
    assert one(cleaning.parse_numeric(raw), "clouds_all", "traffic_volume") == [(None, 40), (12, None)]
    audit = {(r["step"], r["column"]): r["rows_changed"] for r in cleaning.cleaning_audit(raw).collect()}
    assert audit["invalid_number", "clouds_all"] == audit["invalid_number", "traffic_volume"] == audit["drop_incomplete", "all"] == 1


def test_number_parsing(spark):
    df = spark.createDataFrame([(x,) for x in ["1", " 2.5 ", "1e3", "-.5", "1.0d", "x", "", "NaN", None]], "t string")
    assert one(df.select(text.number("t").alias("v")), "v") == [
        (1.0,), (2.5,), (1000.0,), (-0.5,), (None,), (None,), (None,), (None,), (None,)
    ]


def test_date_policies(spark):
    df = cleaning.parse_timestamp(spark.createDataFrame([("2015-01-01 03:00:00",), ("bad",)], "date_time string"))
    assert cleaning.apply_date_policy(df, "drop").count() == 1
    assert cleaning.apply_date_policy(df, "quarantine").count() == 1
    with pytest.raises(DataError, match="1 invalid"):
        cleaning.apply_date_policy(df, "raise")


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert cleaning.drop_exact_duplicates(df).count() == 2
    assert quality.duplicate_count(df, ["a", "b"]).first()[0] == 1
    assert quality.duplicate_count(df.where("a = 2"), ["a", "b"]).first()[0] == 0


def test_month_without_valid_rows_takes_overall_median(spark):
    rows = [(1, 0.0), (2, 280.0), (2, 290.0), (2, -1.0), (3, 300.0), (3, None)]
    df = spark.createDataFrame([(dt.date(2015, m, 1), t) for m, t in rows], "date_time date, temp double")
    rule = [r for r in cleaning.OUTLIER_RULES if r.column == "temp"]
    fixed = cleaning.impute_by_group_median(df, rule, F.month("date_time"), bounded_groups=True)
    assert sorted(one(fixed, "temp"), key=str) == sorted(
        [(290.0,), (280.0,), (290.0,), (285.0,), (300.0,), (None,)], key=str
    )


def test_imputation_keeps_rows_when_nothing_is_valid(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1), -5.0)], "date_time date, temp double")
    rule = [r for r in cleaning.OUTLIER_RULES if r.column == "temp"]
    assert one(cleaning.impute_by_group_median(df, rule, F.month("date_time"), True), "temp") == [(None,)]


def test_schema_differences_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    findings = one(quality.schema_check(df, ["a", "b"]), "check", "column", "level", "rows")
    assert sorted(findings) == [("missing", "b", "error", 1), ("unexpected", "z", "warning", 1)]
    with pytest.raises(DataError, match=r"\['b'\]"):
        quality.require_columns(df, ["a", "b"])
    with pytest.raises(DataError):
        tables.csv_scan_raw(spark, str(tmp_path / "absent.csv"))
    path = tmp_path / "raw.csv"
    path.write_text(",".join(RAW_COLUMNS) + "\nNone,288.28,0,0,40,Clouds,broken,2012-10-02 09:00:00,5545\nshort,1\n")
    landed = {r["holiday"]: r["_corrupt"] for r in tables.csv_scan_raw(spark, str(path)).collect()}
    assert landed == {"None": None, "short": "short,1"}


def test_null_gate(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "a double, b double")
    with pytest.raises(DataError, match="'b': 1"):
        quality.null_gate(df, ["a", "b"])
    assert quality.null_gate(df, ["a"]) is df


def test_request_contract(spark):
    schema = "date_time timestamp_ntz, temp double, rain_1h double, clouds_all int, weather_main string"
    good = (dt.datetime(2018, 1, 1, 8), 280.0, None, 50, "Clear")
    bad = (dt.datetime(2018, 1, 1, 8), 199.9, -1.0, 101, "Hail")
    rows = quality.range_quarantine(spark.createDataFrame([good, bad], schema)).collect()
    assert rows[0]["is_valid"] and rows[0]["rain_1h"] == 0 and rows[0]["is_holiday"] is False
    assert len(rows[1]["reasons"]) == 4 and not rows[1]["is_valid"]


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 10, [float(i * i % 17) for i in range(101)], [0.0] * 90 + [1.5] * 10])
def test_quantiles_equal_numpy(spark, values):
    np = pytest.importorskip("numpy")
    steps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    row = exact_quantiles(df, ["v"], steps).first()
    assert row["n"] == len(values)
    assert np.allclose(row["q"], np.quantile(values, steps))
    assert row["mean"] == pytest.approx(np.mean(values))


def test_quantiles_in_short_rounds(spark, monkeypatch):
    """More rounds of fewer bits still give exact answers for a skewed grouped table."""
    np = pytest.importorskip("numpy")
    from kerbline.functions import quantiles, selection

    monkeypatch.setattr(selection, "ROUND_BITS", 8)
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "b").when(F.col("id") == 1, "rare").alias("g"),
        F.when(F.col("id") % 5 == 0, 0.0).otherwise(F.xxhash64("id") % 100000 / 7.0).alias("v"),
    )
    steps = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["g"]: (r["n"], r["q"]) for r in quantiles.exact_quantiles(df, ["v"], steps, ["g"]).collect()}
    held = df.toPandas()
    for key, part in held.groupby("g", dropna=False):
        key = None if key != key else key
        assert got[key][0] == len(part)
        assert np.allclose(got[key][1], np.quantile(part["v"], steps))
