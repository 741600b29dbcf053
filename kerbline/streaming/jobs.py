"""Continuous scoring and continuous drift monitoring with Structured Streaming."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kerbline.functions.quantiles import long_form
from kerbline.operators import drift
from kerbline.operators.quality import range_quarantine
from kerbline.operators.score import prediction_record, score_features, score_table


def file_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All files of a Parquet table, a folder or a single file, and those that land in it later.

    Files that wait when a batch starts are one batch: rows that are out of order across them are never late. The
    path is given as a pattern that matches itself only, since the reader takes a single file no other way.
    """
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run over everything available, appending exactly once to a Parquet folder."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(requests: DataFrame, model: Transformer, keep: list[str]) -> DataFrame:
    """Stateless: valid requests in, prediction records out."""
    return score_table(requests, model, keep)


def quarantine_stream(requests: DataFrame, keep: list[str]) -> DataFrame:
    return range_quarantine(requests).where(~F.col("is_valid")).select(*keep, "reasons")


def score_to(requests: DataFrame, model: Transformer, keep: list[str], predictions: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Score a stream of requests into two tables: predictions, and refused requests with reasons.

    Both parts of a micro-batch are written under its id, so a batch that is run again after a failure replaces what it wrote
    before. Each request is in one of the tables once; ``accounted`` counts them.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        judged = range_quarantine(batch).persist()
        try:
            write_batch(prediction_record(model.transform(score_features(judged.where("is_valid"), keep)), keep), predictions, batch_id)
            write_batch(judged.where("NOT is_valid").select(*keep, "reasons"), quarantine, batch_id)
        finally:
            judged.unpersist()

    return requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch into its own folder, which a replay of the batch replaces."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def written(spark: SparkSession, path: str) -> DataFrame:
    """What all micro-batches have written, with ``batch_id``."""
    return spark.read.parquet(path)


def accounted(spark: SparkSession, predictions: str, quarantine: str) -> DataFrame:
    """(batch_id, predicted, refused): requests of each micro-batch by outcome."""
    parts = [(predictions, 1, 0), (quarantine, 0, 1)]
    counted = [written(spark, p).select("batch_id", F.lit(a).alias("a"), F.lit(b).alias("b")) for p, a, b in parts]
    return counted[0].unionByName(counted[1]).groupBy("batch_id").agg(F.sum("a").alias("predicted"), F.sum("b").alias("refused"))


def drift_windows(
    rows: DataFrame,
    frozen: DataFrame,
    ts: str = "date_time",
    length: str = "1 day",
    delay: str = "1 hour",
    features: list[str] | None = None,
) -> DataFrame:
    """Index of every closed time window against a frozen reference profile; batch or stream.

    One aggregate holds the bin counts of a (window, feature) as an array, so the state is one row
    per feature and open window and the index itself is a plain projection on the emitted rows.
    """
    features = features or drift.FEATURES
    timed = rows.withColumn("_at", F.col(ts).cast("timestamp"))
    if rows.isStreaming:
        timed = timed.withWatermark("_at", delay)
    long = long_form(timed, features, ["_at"])
    placed = long.join(F.broadcast(frozen.select("feature", "edges")), "feature").withColumn("bin", drift.bin_of())
    profile = placed.groupBy(F.window("_at", length).alias("w"), "feature").agg(
        F.count("v").alias("n"),
        F.avg("v").alias("mean"),
        drift.bin_counts().alias("counts"),
    )
    scored = profile.join(F.broadcast(frozen), "feature").withColumn("psi", drift.psi_value())
    return scored.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "feature",
        F.col("n").alias("records"),
        F.col("mean").alias("current_mean"),
        "psi",
        drift.drift_level(F.col("psi")).alias("drift_level"),
        F.when(F.col("psi") >= drift.ALERT, "ALERT").otherwise("PASS").alias("feature_status"),
    )
