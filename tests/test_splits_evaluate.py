import pytest
from pyspark.sql import functions as F

from kerbline import DataError
from kerbline.functions import ranks, selection
from kerbline.operators import cluster, evaluate, splits


@pytest.fixture(scope="module")
def rows(spark):
    """Keys with one timestamp that holds a third of all rows."""
    return spark.range(3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("t"),
        (F.col("id") % 10 == 0).cast("int").alias("label"),
        F.concat(F.lit("w"), F.col("id") % 4).alias("w"),
    )


def members(df, predicate="is_train"):
    return {r["k"] for r in df.where(predicate).select("k").collect()}


@pytest.mark.parametrize("order", [["t", "k"], ["w", "t", "k"], ["k"]])
@pytest.mark.parametrize("k", [0, 1, 1499, 2400, 3000])
def test_first_rows_equals_a_sort(rows, order, k):
    expected = {r["k"] for r in rows.orderBy(*order).limit(k).collect()}
    assert members(rows, ranks.first_rows(rows, order, k)) == expected


def test_first_rows_in_short_rounds(rows, monkeypatch):
    monkeypatch.setattr(selection, "ROUND_BITS", 8)
    expected = {r["k"] for r in rows.orderBy("t", "k").limit(1500).collect()}
    assert members(rows, ranks.first_rows(rows, ["t", "k"], 1500)) == expected


def test_null_order_values_come_last(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 4), (4, None)], "k int, t int")
    assert members(df, ranks.first_rows(df, ["t", "k"], 2)) == {1, 3}
    with pytest.raises(DataError, match="too few rows"):
        ranks.first_rows(df, ["t", "k"], 3)


def test_ambiguous_order_is_refused(rows):
    with pytest.raises(DataError, match="identify a row"):
        ranks.first_rows(rows, ["t"], 1100 if rows.where("t < 500").count() < 1100 else 1)


def test_splits_ignore_partitioning(rows):
    for split in (
        lambda d: splits.random_split(d, ["k"]),
        lambda d: splits.stratified_split(d, "label", ["k"]),
        lambda d: splits.chronological_split(d, ["t", "k"]),
    ):
        assert members(split(rows)) == members(split(rows.repartition(7)))


def test_split_sizes(rows):
    assert abs(len(members(splits.random_split(rows, ["k"]))) - 2400) < 120
    parts = splits.stratified_split(rows, "label", ["k"]).where("is_train").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in parts} == {0: 2160, 1: 240}


def test_sample_is_exact_and_stable(rows):
    sample = splits.fixed_size_sample(rows, ["k"], 100)
    expected = {r["k"] for r in rows.withColumn("h", ranks.row_hash("k")).orderBy("h", "k").limit(100).collect()}
    assert members(sample, "true") == expected
    assert splits.fixed_size_sample(rows, ["k"], 5000).count() == 3000


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    df = spark.range(1000).select((F.xxhash64("id") / 1e9).alias("x"), (F.col("id") % 7).alias("n"))
    out = ranks.running_totals(df, "x", ["n"], descending, slices=16).collect()
    total = 0
    for r in sorted(out, key=lambda r: r["x"], reverse=descending):
        assert r["before_n"] == total
        total += r["n"]


def test_classification_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = evaluate.classification_metrics(df, "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_auc_with_ties(spark):
    pairs = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    df = spark.createDataFrame(pairs, "y int, s double")
    wins = sum((p > n) + 0.5 * (p == n) for y, p in pairs if y for z, n in pairs if not z)
    assert evaluate.roc_auc(df, "y", "s").first()[0] == pytest.approx(wins / 6)
    curve = sorted(evaluate.roc_curve(df, "y", "s").collect(), key=lambda r: -r["threshold"])
    assert [(r.fpr, r.tpr) for r in curve][0] == (0.0, 0.0) and [(r.fpr, r.tpr) for r in curve][-1] == (1.0, 1.0)
    assert len(curve) == 4


def test_f1_from_known_precision_and_recall():
    precision, recall = 0.8917568692756037, 0.984375
    assert 2 * precision * recall / (precision + recall) == pytest.approx(0.9357798165137615)


def test_silhouette_by_hand(spark):
    points = [(1, 0, [0.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 1, [5.0, 0.0]), (4, 1, [5.0, 2.0]), (5, 2, [9.0, 9.0])]
    df = spark.createDataFrame(points, "k int, label int, v array<double>")

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    total = 0
    for k, label, v in points:
        own = [dist(v, w) for j, l, w in points if l == label and j != k]
        if not own:
            continue
        a = sum(own) / len(own)
        others = {l for _, l, _ in points if l != label}
        b = min(sum(dist(v, w) for _, l, w in points if l == o) / sum(l == o for _, l, _ in points) for o in others)
        total += (b - a) / max(a, b)
    got = cluster.silhouette(df, "label", "v").first()
    assert got["silhouette"] == pytest.approx(total / 5) and got["rows"] == 5


def test_silhouette_takes_every_row_and_one_cluster_scores_zero(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("label"), F.array(F.col("id") % 3 * 1.0, F.lit(0.0)).alias("v"))
    assert tuple(cluster.silhouette(df, "label", "v").first()) == (1.0, 30_000)
    assert tuple(cluster.silhouette(df.where("label = 1"), "label", "v").first()) == (0.0, 10_000)
