import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline import DataError
from kerbline.operators import drift, recommend, rules, runs


def test_rule_metrics_reproduce_known_rows(spark):
    # Antecedent, consequent and joint support, then six measures.
    known = [
        (0.07269595534065204, 0.25000518812127753, 0.06441571378172536,
         0.8860976306023409, 3.5443169690242384, 0.046241347791129664, 6.5845409173212195, 0.7741346492598196, 0.5718775693478211),
        (0.08174403884865213, 0.25000518812127753, 0.06958308257413826,
         0.8512312769738513, 3.4048544487041563, 0.04914664876398996, 5.041347378823018, 0.7691773526251166, 0.564778915651365),
    ]
    df = spark.createDataFrame([k[:3] for k in known], "a double, c double, s double")
    m = rules.rule_metrics(F.col("a"), F.col("c"), F.col("s"))
    names = ["confidence", "lift", "leverage", "conviction", "zhangs_metric", "kulczynski"]
    for row, k in zip(df.select(*[m[n].alias(n) for n in names]).collect(), known):
        assert list(row) == pytest.approx(list(k[3:]), rel=1e-9)


def test_certain_rule_has_infinite_conviction(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5)], "a double, c double, s double")
    m = rules.rule_metrics(F.col("a"), F.col("c"), F.col("s"))
    assert math.isinf(df.select(m["conviction"]).first()[0])


@pytest.fixture(scope="module")
def baskets(spark):
    rows = [("A", "x", "p", "u"), ("A", "x", "q", "u"), ("B", "x", "p", "v"), ("B", "y", None, "v"), ("A", "y", "p", "u")] * 4
    return spark.createDataFrame(rows, "Time string, Day string, Weather string, Congestion string")


def brute_force(rows, least):
    from itertools import combinations

    found = {}
    for row in rows:
        items = sorted(f"{c}={v}" for c, v in row.asDict().items() if v is not None)
        for size in range(1, len(items) + 1):
            for chosen in combinations(items, size):
                found[", ".join(chosen)] = found.get(", ".join(chosen), 0) + 1
    return {k: v for k, v in found.items() if v / len(rows) >= least}


def test_itemsets_equal_brute_force_and_growth(spark, baskets):
    expected = brute_force(baskets.collect(), 0.2)
    cube = {r["itemset"]: r["records"] for r in rules.frequent_itemsets(baskets, min_support=0.2).collect()}
    grown = {r["itemset"]: r["records"] for r in rules.basket_itemsets(rules.basket_build(baskets), min_support=0.2).collect()}
    assert cube == expected and grown == expected


def test_support_falls_as_items_are_added(spark, baskets):
    held = rules.frequent_itemsets(baskets, min_support=0.01).collect()
    support = {frozenset(r["items"]): r["support"] for r in held}
    for items, value in support.items():
        for item in items:
            smaller = items - {item}
            assert not smaller or support[smaller] >= value


def test_rule_filter_keeps_single_target_consequents(spark, baskets):
    found = rules.rule_filter(rules.association_rules(rules.frequent_itemsets(baskets, min_support=0.1))).collect()
    assert found
    assert all(r["consequents"].startswith("Congestion=") and "," not in r["consequents"] for r in found)
    assert not any("Congestion=" in r["antecedents"] for r in found)


@pytest.fixture(scope="module")
def observations(spark):
    rows = []
    for hour in range(24):
        rows += [(0, "Rain", hour, 1000 + 10 * hour + i) for i in range(40)]
        rows += [(0, "Squall", hour, 50)] * 2 + [(1, "Rain", hour, 700 - hour)] * (35 if hour in (8, 9) else 3)
    return spark.createDataFrame(rows, "is_weekend int, weather string, hour int, traffic_volume bigint")


def test_recommendation_uses_weather_when_enough(observations):
    out = recommend.recommend_windows(observations, " weekday ", "rain").collect()
    assert [r["Travel_Window"] for r in sorted(out, key=lambda r: r["Average_Traffic"])][0] == "06:00 to 07:00"
    assert {r["Evidence_Basis"] for r in out} == {recommend.WEATHER_BASIS} and len(out) == 3


@pytest.mark.parametrize("day, weather", [("Weekday", "Squall"), ("Weekend", "Rain")])
def test_recommendation_falls_back_as_a_whole(observations, day, weather):
    out = recommend.recommend_windows(observations, day, weather).collect()
    assert {r["Evidence_Basis"] for r in out} == {recommend.DAY_BASIS} and len(out) == 3


def test_more_windows_than_candidates(observations):
    out = recommend.recommend_windows(observations, "Weekday", "Rain", 22, 24, 5).collect()
    assert len(out) == 2 and "23:00 to 00:00" in {r["Travel_Window"] for r in out}


def test_bad_requests(observations):
    with pytest.raises(DataError, match="unknown weather"):
        recommend.recommend_windows(observations, "Weekday", "Hail")
    for bad in [(24, 24, 1), (0, 25, 1), (9, 9, 1), (6, 22, 0)]:
        with pytest.raises(DataError):
            recommend.check_request(*bad)
    with pytest.raises(DataError, match="day_type"):
        recommend.recommend_windows(observations, "Holiday", "Rain")


# Worked out by hand. Reference 1..10 twice: the deciles part it into ten bins of one tenth each.
# - The same rows again: no change.
# - All current rows in the lowest bin: (1 - 0.1) ln(1 / 0.1) + 9 (0.0001 - 0.1) ln(0.0001 / 0.1) = 8.284065 + ...
# Reference with one value: ten equal bins around it, of which one is used by both: no change.
# Reference half 0, half 1: two distinct deciles, so ten equal bins; shares 1/2, 1/2 against 1/4, 3/4:
# (1/4 - 1/2) ln(1/2) + (3/4 - 1/2) ln(3/2) = 0.173287 + 0.101366 = 0.274653.
TENTHS = [float(i) for i in range(1, 11)] * 2


@pytest.mark.parametrize(
    "reference, current, expected",
    [
        (TENTHS, TENTHS, 0.0),
        (TENTHS, [0.0] * 4, 0.9 * math.log(10) + 9 * 0.0999 * math.log(1000)),
        ([4.0] * 20, [4.0] * 10, 0.0),
        ([0.0] * 10 + [1.0] * 10, [0.0] * 1 + [1.0] * 3, 0.25 * math.log(2) + 0.25 * math.log(1.5)),
    ],
)
def test_psi_of_worked_cases(spark, reference, current, expected):
    ref = spark.createDataFrame([(v,) for v in reference], "x double")
    cur = spark.createDataFrame([("now", v) for v in current], "Scenario string, x double")
    assert drift.psi(ref, cur, ["x"], ["Scenario"]).first()["psi"] == pytest.approx(expected, abs=1e-9)


def test_drift_levels_at_the_limits(spark):
    df = spark.createDataFrame([(0.0999,), (0.10,), (0.1999,), (0.20,)], "p double")
    levels = [r[0] for r in df.select(drift.drift_level(F.col("p"))).collect()]
    assert levels == ["No material drift", "Moderate change", "Moderate change", "Material drift"]


def test_small_reference_is_refused(spark):
    df = spark.range(9).withColumnRenamed("id", "k")
    with pytest.raises(DataError, match="fewer reference rows"):
        drift.reference_rows(df, ["k"])


def test_every_reference_row_is_monitored(spark):
    df = spark.range(9000).withColumnRenamed("id", "k")
    reference = drift.reference_rows(df, ["k"])
    assert drift.monitored_rows(reference, ["k"]).count() == 7200
    assert 600 < drift.monitored_rows(reference, ["k"], 0.1).count() < 850


def test_latest_run_per_version(spark):
    rows = [("m1", 1, "a"), ("m1", 3, "b"), ("m1", 3, "c"), ("m2", 1, "d"), (None, 9, "e")]
    df = spark.createDataFrame(rows, "version string, start int, run string")
    out = runs.latest_per_key(df, F.col("version"), [F.col("start"), F.col("run")])
    assert {(r["key"], r["run"]) for r in out.collect()} == {("m1", "c"), ("m2", "d")}
