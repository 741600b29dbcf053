"""Supervised models on the 23 serving features: forests from binned rows (``forest``), the others by Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.operators import forest
from kerbline.operators.features import adverse_weather_flag, cyclical_encode, model_columns, proxy_risk_label
from kerbline.operators.splits import chronological_cut
from kerbline.shared import attach, shared_folder

SEED = 42
FOREST_MEMORY_MB = 1024
SMALL_TRAIN_ROWS = 1_000_000
KIND = "_model"


def training_table(features: DataFrame, keys: list[str], target: str = "traffic_volume") -> DataFrame:
    """Key columns, the 23 inputs as doubles, the measure, the proxy risk label and the time."""
    ready = features.transform(cyclical_encode).transform(adverse_weather_flag).transform(proxy_risk_label)
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in model_columns()]
    extra = [c for c in dict.fromkeys([*keys, "date_time"])]
    return ready.select(*extra, *inputs, F.col(target).cast("double").alias(target), F.col("risk_label").cast("double").alias("risk_label"))


def assembler(columns: list[str] | None = None, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns or model_columns(), outputCol=output)


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class) on every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_t"), F.count(F.lit(1)).alias("_k"))
    weights = attach(counts, totals).select(
        F.col(label).alias("_c"), (F.col("_t") / (F.col("_k") * F.col("_n"))).alias(name)
    )
    return df.join(F.broadcast(weights), F.col(label) == F.col("_c")).drop("_c")


def spread(train: DataFrame) -> DataFrame:
    """A small table sits in few files; give every core a share. Large tables keep their partitions."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(cores) if train.count() < SMALL_TRAIN_ROWS else train


def _fit(train: DataFrame, stages: list, columns: list[str]) -> PipelineModel:
    """Fit on the needed columns, held for the several passes every learner makes."""
    shared_folder(train.sparkSession)  # tree node ids are checkpointed there
    held = train.select(*model_columns(), *columns).persist()
    try:
        return Pipeline(stages=stages).fit(held)
    finally:
        held.unpersist()


def logistic_classifier(train: DataFrame, label: str = "risk_label") -> PipelineModel:
    weighted = balanced_weights(train, label)
    rows = train.count()
    return _fit(
        weighted,
        [
            assembler(output="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(
                labelCol=label, weightCol="weight", maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False
            ),
        ],
        [label, "weight"],
    )


def forest_classifier(train: DataFrame, label: str = "risk_label", trees: int = 200, depth: int = 12) -> forest.Forest:
    return forest.fit(balanced_weights(train, label), label, model_columns(), trees, depth, 32, seed=SEED, weight="weight", classes=True)


def linear_regressor(train: DataFrame, target: str = "traffic_volume") -> PipelineModel:
    """Standardised least squares; a tiny ridge keeps the complete one-hot block solvable."""
    return _fit(
        train,
        [
            assembler(output="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LinearRegression(labelCol=target, solver="normal", regParam=1e-6),
        ],
        [target],
    )


def forest_regressor(
    train: DataFrame, target: str = "traffic_volume", trees: int = 200, depth: int = 18, bins: int = 256
) -> forest.Forest:
    return forest.fit(train, target, model_columns(), trees, depth, bins, seed=SEED)


def boosted_regressor(
    train: DataFrame, target: str = "traffic_volume", order: list[str] | None = None, rounds: int = 40
) -> PipelineModel:
    """Gradient boosting that stops early on the last fifth of the training rows in time order."""
    order = order or ["date_time"]
    marked = train.withColumn("validation", ~chronological_cut(train, order, 0.8))
    return _fit(
        spread(marked),
        [
            assembler(),
            GBTRegressor(
                labelCol=target, maxIter=rounds, maxDepth=6, validationIndicatorCol="validation",
                stepSize=0.2, maxBins=64, maxMemoryInMB=FOREST_MEMORY_MB, cacheNodeIds=True, seed=SEED,
            ),
        ],
        [target, "validation"],
    )


def predict_batch(model: Transformer | forest.Forest, rows: DataFrame) -> DataFrame:
    """Scores beside the rows; classifiers also give the class-1 probability."""
    scored = model.transform(rows)
    if "probability" in scored.columns:
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    inner = {"raw_features", "features", "rawPrediction", "probability", "weight"}
    return scored.drop(*[c for c in scored.columns if c in inner])


def save_model(model: PipelineModel | forest.Forest, path: str, metadata: dict[str, str]) -> None:
    """Fitted stages or a forest plus a one-row metadata table (feature list, target, version ...)."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, forest.Forest):
        model.save(f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    kept = {**metadata, KIND: "forest" if isinstance(model, forest.Forest) else "stages"}
    spark.createDataFrame([(kept,)], "metadata map<string,string>").write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(path: str) -> tuple[PipelineModel | forest.Forest, dict[str, str]]:
    spark = SparkSession.getActiveSession()
    metadata = spark.read.parquet(f"{path}/metadata").first()["metadata"]
    kind = metadata.pop(KIND, "stages")
    return (forest.Forest if kind == "forest" else PipelineModel).load(f"{path}/model"), metadata
