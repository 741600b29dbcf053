"""Radix selection, splits of many classes, running totals, exact tree explanations, the network and shared k-means passes."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.functions import quantiles, ranks, selection
from kerbline.operators import cluster, drift, lloyd, models, network, reference_store, splits, treeshap
from kerbline.shared import fresh_path, setting

RNG = random.Random(7)


def doubles(n):
    pool = [0.0, -0.0, 1.5, -1.5, 1e-300, -1e300, 5e-324, math.inf, -math.inf, 7.0]
    return [RNG.choice(pool) if RNG.random() < 0.4 else RNG.uniform(-1e3, 1e3) * 10 ** RNG.randint(-8, 8) for _ in range(n)]


def test_selected_ranks_equal_a_sort(spark):
    groups = {g: doubles(n) for g, n in (("a", 1), ("b", 2), (None, 300), ("c", 2000))}
    groups["same"] = [2.25] * 500
    data = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("empty", None)]
    rows = spark.createDataFrame(data, "g string, v double")
    wanted = F.array(F.lit(0), F.floor(F.col("size") / 3), F.col("size") - 1, F.col("size"))
    found = selection.select_ranks(rows, ["g"], "v", wanted).collect()
    assert {r["g"] for r in found} == set(groups)
    for r in found:
        values = sorted(groups[r["g"]])
        assert r["size"] == len(values)
        assert r["value"] == values[r["rank"]]
        assert r["before"] == sum(v < r["value"] for v in values)
        assert r["equal"] == values.count(r["value"])
    assert len(found) == sum(len({0, len(v) // 3, len(v) - 1}) for v in groups.values())


@pytest.mark.parametrize("kind, values", [
    ("bigint", [-(2**63), -5, 0, 3, 2**63 - 1, 70_000, 70_001]),
    ("date", ["1969-12-31", "1970-01-01", "2020-02-29", "0099-01-01"]),
    ("timestamp_ntz", ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2021-03-28 02:30:00", "2021-03-28 02:30:00.000001"]),
    ("timestamp", ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2021-03-28 02:30:00"]),
])
def test_order_of_bits(spark, kind, values):
    rows = spark.createDataFrame([(str(v),) for v in values], "t string").select(F.col("t").cast(kind).alias("v"))
    keyed = rows.select("v", selection.ordered_bits(F.col("v"), kind).alias("k"))
    assert [r["v"] for r in keyed.orderBy("k").collect()] == sorted(r["v"] for r in rows.collect())
    assert keyed.select("k").distinct().count() == len(values)
    middle = selection.select_ranks(rows, [], "v", F.array(F.lit(len(values) // 2))).first()["value"]
    assert middle == sorted(r["v"] for r in rows.collect())[len(values) // 2]


def test_text_has_no_order_of_bits(spark):
    with pytest.raises(DataError):
        selection.select_ranks(spark.createDataFrame([("x",)], "v string"), [], "v", F.array(F.lit(0)))


def test_quantiles_of_groups(spark):
    rng = np.random.default_rng(1)
    values = {g: np.round(rng.normal(size=n), 2) for g, n in ((0, 1), (1, 5), (2, 999))}
    rows = spark.createDataFrame([(int(g), float(v)) for g, vs in values.items() for v in vs] + [(2, float("nan")), (3, None)], "g int, v double")
    steps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r["g"]: r for r in quantiles.exact_quantiles(rows, ["v"], steps, ["g"]).collect()}
    assert set(found) == {0, 1, 2}
    for g, vs in values.items():
        assert found[g]["q"] == pytest.approx(np.quantile(vs, steps).tolist(), abs=1e-12)
        assert (found[g]["n"], found[g]["mean"]) == (len(vs), pytest.approx(vs.mean()))
    assert quantiles.exact_quantiles(rows.limit(0), ["v"], steps, ["g"]).count() == 0


def test_split_of_many_classes(spark):
    rows = spark.range(30_000).select(F.col("id"), (F.col("id") % 2500).alias("c")).withColumn("c", F.when(F.col("c") < 2400, F.col("c")))
    marked = splits.stratified_split(rows, "c", ["id"])
    sizes = {r["c"]: (r["n"], r["t"]) for r in marked.groupBy("c").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t")).collect()}
    assert len(sizes) == 2401
    assert all(t == math.floor(0.8 * n) for n, t in sizes.values())


def test_split_with_equal_hashes(spark, monkeypatch):
    """Where all hashes are one, the keys decide; rows that keys do not tell apart are an error."""
    monkeypatch.setattr(splits, "row_hash", lambda *keys, seed=42: F.lit(5).cast("bigint"))
    rows = spark.range(20).select("id", F.lit("x").alias("c"))
    kept = splits.stratified_split(rows, "c", ["id"]).where("is_train").collect()
    assert sorted(r["id"] for r in kept) == list(range(16))
    with pytest.raises(Exception, match="do not identify"):
        splits.stratified_split(rows.withColumn("id", F.lit(1)), "c", ["id"]).collect()


def test_running_totals_follow_the_row_count(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SLICE_ROWS", 100)
    df = spark.range(1234).select(((F.col("id") * 7919) % 1234).cast("double").alias("x"), F.col("id").alias("n"))
    rows = sorted((r["x"], r["n"]) for r in df.collect())
    for descending in (False, True):
        out = {r["x"]: r["before_n"] for r in ranks.running_totals(df, "x", ["n"], descending).collect()}
        total = 0
        for x, n in rows[::-1] if descending else rows:
            assert out[x] == total
            total += n


def forest_rows(spark, n=400):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = 3 * x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=0.1, size=n)
    return spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, y double")


@pytest.fixture(scope="module")
def small_forest(spark):
    rows = forest_rows(spark)
    stage = models.RandomForestRegressor(labelCol="y", numTrees=4, maxDepth=5, minInstancesPerNode=2, featureSubsetStrategy="all", seed=1)
    return rows, models.Pipeline(stages=[models.assembler(["a", "b", "c", "d"]), stage]).fit(rows)


def expected_given(nodes, row, known, at=0):
    """Prediction of a tree when only some inputs are known: both sides by their training shares elsewhere."""
    node = nodes[at]
    if node["left"] < 0:
        return node["value"]
    if node["feature"] in known:
        return expected_given(nodes, row, known, node["left"] if row[node["feature"]] <= node["threshold"] else node["right"])
    sides = [nodes[node[s]] for s in ("left", "right")]
    return sum(s["cover"] / node["cover"] * expected_given(nodes, row, known, s["id"]) for s in sides)


def test_tree_contributions_equal_all_coalitions(spark, small_forest):
    rows, model = small_forest
    trees = {}
    for n in treeshap.node_table(model).collect():
        trees.setdefault(n["tree"], {})[n["id"]] = n
    leaves = treeshap.leaf_table(model)
    columns = ["a", "b", "c", "d"]
    found = {r["id"]: r["contributions"] for r in treeshap.contributions(leaves, rows, ["id"], columns).collect()}
    assert len(found) == rows.count()
    for row in rows.limit(12).collect():
        x = [row[c] for c in columns]
        for i in range(4):
            others = [j for j in range(4) if j != i]
            exact = 0.0
            for size in range(4):
                weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                for known in combinations(others, size):
                    exact += weight * sum(expected_given(t, x, {*known, i}) - expected_given(t, x, set(known)) for t in trees.values()) / len(trees)
            assert found[row["id"]][i] == pytest.approx(exact, abs=1e-9)


@pytest.mark.parametrize("entries", [10**9, 150])
def test_contributions_add_up_in_any_blocks(spark, small_forest, monkeypatch, entries):
    monkeypatch.setattr(treeshap, "BLOCK_ENTRIES", entries)
    rows, model = small_forest
    leaves = treeshap.leaf_table(model)
    base = treeshap.base_value(leaves)
    parts = {r["id"]: sum(r["contributions"]) for r in treeshap.contributions(leaves, rows, ["id"], ["a", "b", "c", "d"]).collect()}
    for r in model.transform(rows).select("id", "prediction").collect():
        assert base + parts[r["id"]] == pytest.approx(r["prediction"], abs=1e-9)


def test_network_gradients_are_slopes():
    rng = np.random.default_rng(0)
    weights = [w.astype(np.float64) for w in network.start_weights([3, 5, 4, 1], 1)]
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)

    def loss(ws):
        return 0.5 * ((network.forward(ws, x)[0][-1][:, 0] - y) ** 2).sum()

    for k, slope in enumerate(network.gradients(weights, x, y)):
        for at in np.ndindex(weights[k].shape):
            near = []
            for step in (1e-6, -1e-6):
                moved = [w.copy() for w in weights]
                moved[k][at] += step
                near.append(loss(moved))
            assert (near[0] - near[1]) / 2e-6 == pytest.approx(slope[at], abs=1e-4)


def test_network_learns_and_stops(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 2))
    y = 100 + 20 * np.abs(x[:, 0]) + 5 * x[:, 1]
    rows = spark.createDataFrame([(k, float(a), float(b), 1.0, float(t)) for k, ((a, b), t) in enumerate(zip(x, y))], "id int, a double, b double, one double, y double")
    fitted = network.fit_network(rows, ["id"], "y", ["a", "b", "one"], most_steps=200, patience=15)
    errors = network.predict(fitted, rows).select(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert errors < 3 and fitted.best_step <= fitted.steps <= 200
    with pytest.raises(DataError):
        network.fit_network(rows.limit(0), ["id"], "y", ["a", "b", "one"])


def test_network_sums_do_not_depend_on_groups(spark):
    rows = spark.range(500).select(F.col("id"), F.rand(1).alias("a"), F.rand(2).alias("y")).repartition(6)
    path, *_ = network.packed(rows, ["a"], "y", ["id"])
    blocks = spark.read.schema("held boolean, block binary").parquet(path)
    weights = network.start_weights([1, *network.HIDDEN, 1], 3)
    sums = [network.one_pass(blocks, weights, 1, 9, many) for many in (False, True)]
    assert np.allclose(sums[0], sums[1])
    assert sums[0][0] == 400 and sums[0][2] == 100


def test_shared_fits_equal_separate_ones(spark):
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(c, 0.3, (150, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    rows = spark.createDataFrame([(p.tolist(),) for p in points], "features array<double>").repartition(5)
    wanted = [(k, restart) for k in (2, 3) for restart in range(3)]
    together = lloyd.fit_all(rows, "features", wanted)
    for fit, own in zip(together, wanted):
        alone = lloyd.fit_all(rows.repartition(3), "features", [own])[0]
        assert fit.inertia == pytest.approx(alone.inertia) and fit.passes == alone.passes
        assert np.allclose(fit.centers, alone.centers)
        away = ((points[:, None] - fit.centers[None]) ** 2).sum(axis=2)
        assert fit.inertia == pytest.approx(away.min(axis=1).sum())
        named = {r["cluster"]: r["n"] for r in fit.transform(rows).groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        assert named == {k: int(n) for k, n in enumerate(np.bincount(away.argmin(axis=1), minlength=fit.size)) if n}
    best = min(f.inertia for f in together if f.size == 3)
    assert best < 150 * 3 * 0.3


def test_fewer_rows_than_centers(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],), ([3.0, 4.0],), (None,)], "features array<double>")
    fit = lloyd.fit_all(rows, "features", [(3, 0)])[0]
    assert fit.inertia == 0 and fit.transform(rows).where("cluster IS NULL").count() == 1
    with pytest.raises(DataError):
        lloyd.fit_all(rows.limit(0), "features", [(2, 0)])


def test_daily_sketches_are_the_exact_reference_while_small(spark):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame(
        [(f"2020-01-{1 + k % 5:02d} 10:00:00", float(v), float(k % 3), 7.0) for k, v in enumerate(np.round(rng.normal(size=600), 1))], "t string, a double, b double, c double"
    ).withColumn("date_time", F.col("t").cast("timestamp_ntz"))
    path, names = fresh_path(spark, "store"), ["a", "b", "c"]
    day = F.to_date("date_time")
    reference_store.add_days(rows.where(day < "2020-01-05"), path, "v1", names)
    reference_store.add_days(rows.where(day == "2020-01-05"), path, "v1", names)
    reference_store.add_days(rows.where(day == "2020-01-05"), path, "v1", names)  # again: the day is replaced
    reference_store.add_days(rows.limit(0), path, "v1", names)
    frozen = {r["feature"]: r for r in reference_store.frozen_reference(reference_store.merged(spark, path, "v1")).collect()}
    exact = drift.bin_profile(rows, spark.createDataFrame([(f, list(frozen[f]["edges"])) for f in names], "feature string, edges array<double>"), [], names)
    for r in exact.collect():
        held = frozen[r["feature"]]
        assert (held["reference_rows"], held["reference_counts"]) == (r["n"], r["counts"])
        assert held["reference_mean"] == pytest.approx(r["mean"])
    # A rank of the sketch is a value of the table; the exact edges lie between neighbouring values.
    for r in drift.psi_bin_edges(rows, ["b", "c"]).collect():
        assert frozen[r["feature"]]["edges"] == r["edges"]
    assert reference_store.merged(spark, path, "v2").count() == 0


def test_silhouettes_of_all_fits_equal_those_one_by_one(spark):
    rows = spark.range(700).selectExpr("array(double(id % 7), cast(id % 11 as double) / 3, double(id * id % 13)) AS features")
    packed = lloyd.Rows(rows, "features")
    fits = lloyd.fit_all(packed, "features", [(2, 0), (3, 0), (5, 1)])
    fits.append(lloyd.Centers(3, 9, np.vstack([fits[0].centers, [[900.0, 0, 0]]]), 0.0, 1))  # a center without members
    alone = [cluster.silhouette(f.transform(rows), "cluster", "features").first()["silhouette"] for f in fits]
    assert np.allclose(lloyd.silhouettes(packed, fits), alone, atol=1e-9)
    assert cluster.kmeans_sweep(rows, [2, 3], 2)[0].count() == 2
    # Equal distances go to the first center.
    for size, part in zip((2, 3), lloyd._assigned(packed, [np.zeros((2, 3)), np.array([[1.0, 1, 1], [1, 1, 1], [5, 5, 5]])])):
        assert len(part) == size and part[1, 0] == 0 and part[:, 0].sum() == 700


def test_dropout_keeps_its_share_and_the_mean():
    masks = network.dropout(np.random.SFC64([3, 4]), 20_001)
    for mask, width, p in zip(masks, network.HIDDEN, network.DROPOUT):
        assert mask.shape == (20_001, width) and mask.dtype == np.float32
        assert np.mean(mask == 0) == pytest.approx(p, abs=0.002) and mask.mean() == pytest.approx(1, abs=0.003)
    again = network.dropout(np.random.SFC64([3, 4]), 20_001)
    assert all((a == b).all() for a, b in zip(masks, again))


def test_network_blocks_are_read_by_many_tasks(spark):
    rows = spark.range(0, 400_000, 1, 2).selectExpr("id", "double(id % 97) AS a", "double(id % 89) AS y")
    path, *_ = network.packed(rows, ["a"], "y", ["id"])
    with setting(spark, "spark.sql.files.maxPartitionBytes", "300000"):
        blocks = spark.read.schema("held boolean, block binary").parquet(path)
        per_task = blocks.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 2


def test_a_pass_reads_its_rows_once(spark):
    rows = spark.range(0, 9000, 1, 3).selectExpr("array(double(id), double(id % 7)) AS features")
    packed, read = lloyd.Rows(rows, "features"), spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(len(x))
        return np.array([float(len(x))])

    assert packed.fold(seen, np.add)[0] == 9000 and read.value == 9000
