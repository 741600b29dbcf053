"""Models, scoring and streams on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from kerbline.operators import cluster, drift, evaluate, explain, models, score, splits
from kerbline.plans import landed
from kerbline.plans import queries as q
from kerbline.shared import fresh_path
from kerbline.sources.fixture import KEY, traffic_raw
from kerbline.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_rows(spark):
    rows = models.training_table(landed.features(spark, SF_DIR), KEY)
    marked = splits.random_split(rows, KEY)
    return marked.where("is_train").drop("is_train"), marked.where("NOT is_train").drop("is_train")


@pytest.fixture(scope="module")
def forest(split_rows):
    return models.forest_regressor(split_rows[0], trees=10, depth=8)


def mae(model, test):
    return evaluate.regression_metrics(models.predict_batch(model, test), "traffic_volume", "prediction").first()["mae"]


def test_forest_beats_linear(split_rows, forest):
    train, test = split_rows
    assert mae(forest, test) < mae(models.linear_regressor(train), test)


def test_boosted_regressor(split_rows):
    train, test = split_rows
    model = models.boosted_regressor(train, order=q.ORDER, rounds=10)
    assert mae(model, test) < 1000


@pytest.mark.parametrize("fit", [models.logistic_classifier, lambda d: models.forest_classifier(d, trees=10, depth=6)])
def test_classifiers(split_rows, fit):
    train, test = split_rows
    scored = models.predict_batch(fit(train), test)
    assert evaluate.roc_auc(scored, "risk_label", "score").first()[0] > 0.9


def test_store_keeps_scores(spark, split_rows, forest):
    path = fresh_path(spark, "model")
    models.save_model(forest, path, {"target": "traffic_volume"})
    again, metadata = models.load_model(path)
    assert metadata == {"target": "traffic_volume"}
    assert mae(again, split_rows[1]) == mae(forest, split_rows[1])


def test_shapley_adds_up(split_rows, forest):
    test = split_rows[1]
    parts = explain.shapley_rows(forest, test, KEY, sample_rows=40, permutations=6)
    sums = parts.groupBy(*KEY, "permutation").agg(F.sum("contribution").alias("gain"))
    sample = splits.fixed_size_sample(test, KEY, 40)
    scores = [r["prediction"] for r in models.predict_batch(forest, sample).select("prediction").collect()]
    # Every row starts from another row of the sample, so the gains cancel within a permutation.
    per = sums.groupBy("permutation").agg(F.sum("gain").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["n"] == 40 and abs(r["s"]) < 1e-6 * max(scores) for r in per)


def test_importance_finds_the_hour(split_rows, forest):
    ranked = explain.permutation_importance(forest, split_rows[1], KEY).orderBy(F.col("importance").desc()).collect()
    assert ranked[0]["feature"] in ("hour_cos", "hour_sin") and len(ranked) == 23


def test_sweep_and_selection(spark):
    vectors = cluster.cluster_table(landed.features(spark, SF_DIR), KEY)
    sweep, fitted = cluster.kmeans_sweep(vectors, sizes=[2, 3], restarts=2)
    rows = {r["clusters"]: r for r in sweep.collect()}
    assert rows[3]["inertia"] < rows[2]["inertia"]
    chosen = cluster.select_size(sweep)
    named = cluster.cluster_naming(cluster.cluster_profiles(fitted[chosen].transform(vectors)))
    assert sum(r["records"] for r in named.collect()) == vectors.count()


def test_score_stream_equals_batch(spark, forest):
    requests = q._requests(traffic_raw(spark, SF_DIR))
    batch = score.score_table(requests, forest, KEY)
    out, state = fresh_path(spark, "scores"), fresh_path(spark, "state")
    stream = jobs.score_stream(q._requests(q._event_stream(spark, SF_DIR)), forest, KEY)
    jobs.append_to(stream, out, state).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_drift_stream_equals_closed_batch_windows(spark):
    frozen = q._frozen(spark, SF_DIR)
    batch = jobs.drift_windows(q._monitored(traffic_raw(spark, SF_DIR)), frozen)
    out, state = fresh_path(spark, "drift"), fresh_path(spark, "state")
    stream = jobs.drift_windows(q._monitored(q._event_stream(spark, SF_DIR)), frozen)
    jobs.append_to(stream, out, state).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() > 0
    assert q.tidy(streamed).exceptAll(q.tidy(batch)).count() == 0
    left = batch.select("window_start").distinct().count() - streamed.select("window_start").distinct().count()
    assert 0 < left <= 2


def test_stream_of_a_folder_of_disordered_files_equals_the_batch(spark):
    folder = fresh_path(spark, "many-files")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(4).write.parquet(f"{folder}/events.parquet")
    frozen = q._frozen(spark, SF_DIR)
    out, state = fresh_path(spark, "drift"), fresh_path(spark, "state")
    stream = jobs.drift_windows(q._monitored(q._event_stream(spark, folder)), frozen)
    jobs.append_to(stream, out, state).awaitTermination()
    streamed, batch = q.tidy(spark.read.parquet(out)), q.tidy(jobs.drift_windows(q._monitored(traffic_raw(spark, SF_DIR)), frozen))
    closed = streamed.select("window_start").distinct()
    assert streamed.exceptAll(batch).count() == 0 and batch.join(closed, "window_start").exceptAll(streamed.select(batch.join(closed, "window_start").columns)).count() == 0
    assert batch.select("window_start").distinct().count() - closed.count() <= 2


def test_drift_report_shape(spark):
    rows = landed.features(spark, SF_DIR)
    report = drift.drift_report(rows, q.ORDER, KEY, share=0.5).collect()
    status = {r["Scenario"]: r["Overall_Status"] for r in report}
    assert len(report) == 10 and status[drift.SHIFTED].startswith("ALERT")
