"""K-means segmentation: sweep, selection, exact silhouette and profiles."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.operators import lloyd
from kerbline.operators.describe import share_of_total
from kerbline.operators.features import adverse_weather_flag, zscore
from kerbline.operators.quality import median_fill
from kerbline.shared import attach

# Fixed values.
CLUSTER_FEATURES = [
    "hour_sin", "hour_cos", "traffic_volume", "temp",
    "rain_1h", "snow_1h", "clouds_all", "adverse_weather",
]
SIZES = [2, 3, 4, 5, 6]
RESTARTS = 10


def cluster_table(features: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the eight standardised inputs as a ``features`` vector, nulls filled by medians."""
    flagged = adverse_weather_flag(features)
    others = [c for c in dict.fromkeys([*keys, "date_time", "hour", "is_weekend"]) if c not in CLUSTER_FEATURES]
    filled = median_fill(flagged.select(*others, *[F.col(c).cast("double").alias(c) for c in CLUSTER_FEATURES]), CLUSTER_FEATURES)
    scaled = zscore(filled, CLUSTER_FEATURES)
    return (
        VectorAssembler(inputCols=[f"{c}_scaled" for c in CLUSTER_FEATURES], outputCol="features")
        .transform(scaled)
        .drop(*[f"{c}_scaled" for c in CLUSTER_FEATURES])
    )


def silhouette_rows(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, silhouette) of every row, with the squared Euclidean distance.

    The distances of a row to all members of a cluster add up to n |x|^2 + q - 2 x.s, from the cluster's count n, vector
    sum s and sum of squared norms q. So one aggregate with a row per cluster, put beside the rows, scores all of
    them in one more pass. The only row of its cluster scores 0; rows without a label or a vector are left out.
    """
    is_array = dict(df.dtypes)[vector].startswith("array")
    array = F.col(vector).cast("array<double>") if is_array else vector_to_array(vector)
    rows = df.select(F.col(label).alias("label"), array.alias("x")).where("label IS NOT NULL AND x IS NOT NULL")
    normed = rows.withColumn("norm", _dot(F.col("x"), F.col("x")))
    clusters = normed.groupBy("label").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("norm").alias("q"),
        vector_to_array(Summarizer.sum(array_to_vector("x"))).alias("s"),
    )
    placed = attach(normed, clusters.agg(F.collect_list(F.struct("label", "n", "q", "s")).alias("clusters")))

    def total(c: Column) -> Column:
        return F.greatest(c["n"] * F.col("norm") + c["q"] - 2 * _dot(F.col("x"), c["s"]), F.lit(0.0))

    own = F.filter("clusters", lambda c: c["label"] == F.col("label"))[0]
    others = F.filter("clusters", lambda c: c["label"] != F.col("label"))
    scored = placed.select(
        "label",
        own["n"].alias("n"),
        (total(own) / F.greatest(own["n"] - 1, F.lit(1.0))).alias("a"),
        F.array_min(F.transform(others, lambda c: total(c) / c["n"])).alias("b"),
    )
    widest = F.greatest("a", "b")
    value = F.when((F.col("n") > 1) & F.col("b").isNotNull() & (widest > 0), (F.col("b") - F.col("a")) / widest)
    return scored.select("label", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)


def silhouette(df: DataFrame, label: str, vector: str) -> DataFrame:
    rows = silhouette_rows(df, label, vector)
    return rows.agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("rows"))


def kmeans_sweep(
    vectors: DataFrame, sizes: list[int] | None = None, restarts: int = RESTARTS
) -> tuple[DataFrame, dict[int, lloyd.Centers]]:
    """(clusters, inertia, silhouette) per candidate size, and the best fit of each; the rows are packed once, and all fits share
    their passes."""
    sizes = sizes or SIZES
    packed = lloyd.Rows(vectors, "features")
    fits = lloyd.fit_all(packed, "features", [(k, restart) for k in sizes for restart in range(restarts)])
    best = {k: min((f for f in fits if f.size == k), key=lambda f: (f.inertia, f.restart)) for k in sizes}
    scores = silhouettes(packed, best)
    rows = [(k, best[k].inertia, scores[k]) for k in sizes]
    return vectors.sparkSession.createDataFrame(rows, "clusters int, inertia double, silhouette double"), best


def silhouettes(rows: lloyd.Rows, fits: dict[int, lloyd.Centers]) -> dict[int, float]:
    """The silhouette of every fit over all rows."""
    return dict(zip(fits, lloyd.silhouettes(rows, list(fits.values()))))


def select_size(sweep: DataFrame) -> int:
    """Size with the highest silhouette, the smallest on a tie."""
    best = F.max_by("clusters", F.struct(F.col("silhouette"), (-F.col("clusters")).alias("k")))
    return sweep.agg(best.alias("k")).first()["k"]


def cluster_profiles(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    groups = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("records"),
        F.avg("hour").alias("average_hour"),
        F.avg("traffic_volume").alias("average_traffic"),
        F.avg("temp").alias("average_temperature"),
        F.avg("rain_1h").alias("average_rainfall"),
        F.avg("snow_1h").alias("average_snowfall"),
        F.avg("clouds_all").alias("average_cloud_cover"),
        F.avg("adverse_weather").alias("adverse_weather_rate"),
        F.avg("is_weekend").alias("weekend_rate"),
    )
    return share_of_total(groups)


def cluster_name() -> Column:
    """Name a profile row by what sets it apart; ids carry no meaning across fits.

    The thresholds are fixed values.
    """
    return (
        F.when(F.col("average_rainfall") >= 2, "Rare heavy-rain traffic")
        .when(F.col("average_snowfall") >= 0.1, "Rare cold-and-snow traffic")
        .when(F.col("adverse_weather_rate") >= 0.5, "Adverse-weather moderate-demand traffic")
        .when(F.col("average_traffic") >= F.col("overall_traffic"), "High-demand normal-weather traffic")
        .otherwise("Low-demand normal-weather traffic")
    )


def cluster_naming(profiles: DataFrame) -> DataFrame:
    """Add ``cluster_name``; demand is judged against the record-weighted mean of all clusters."""
    overall = profiles.agg(
        (F.sum(F.col("average_traffic") * F.col("records")) / F.sum("records")).alias("overall_traffic")
    )
    named = attach(profiles, overall).withColumn("cluster_name", cluster_name())
    return named.drop("overall_traffic")
