"""Windowed drift counts on a stream that keeps what comes too late.

A stateful operator holds, for each open window and salt, the bin counts of every feature, with a timer at the end of the
window. When the watermark passes it, the counts are emitted and the state is dropped. Rows of a window that has closed go out
as late rows, so nothing is lost: window rows plus late rows are all rows.

Windows are split by salts of a row hash, so that a day that holds most rows is counted in many tasks; the parts of a window
are emitted in one micro-batch and added up in the sink. Both outputs of a micro-batch are written under its id.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kerbline.functions.quantiles import long_form
from kerbline.operators import drift
from kerbline.streaming.jobs import write_batch

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SALTS = 16
OUT = "kind string, window_start bigint, feature string, n bigint, s double, counts array<bigint>, row string"


class WindowCounts(StatefulProcessor):
    """Counts of one window and salt: for each feature the rows, their sum and the rows of each bin."""

    def __init__(self, features: list[str], edges: dict[str, list[float]], seconds: int) -> None:
        self.features, self.edges, self.seconds = features, edges, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("counts", "parts string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = (key[0] + self.seconds) * 1000
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield _late(key[0], part)
            return
        fresh = not self.held.exists()
        parts = {f: [0, 0.0, [0] * drift.BINS] for f in self.features} if fresh else json.loads(self.held.get()[0])
        for part in rows:
            for feature in self.features:
                values = part[feature].dropna().to_numpy(float)
                bins = np.bincount(np.searchsorted(self.edges[feature][1:-1], values, side="right"), minlength=drift.BINS)
                n, total, counts = parts[feature]
                parts[feature] = [n + len(values), total + float(values.sum()), [int(a + b) for a, b in zip(counts, bins)]]
        self.held.update((json.dumps(parts),))
        if fresh:
            self.handle.registerTimer(end)
        return
        yield  # nothing goes out before the window closes

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        parts = json.loads(self.held.get()[0])
        self.held.clear()
        out = [("window", key[0], f, n, s, counts, None) for f, (n, s, counts) in parts.items() if n]
        yield pd.DataFrame(out, columns=["kind", "window_start", "feature", "n", "s", "counts", "row"])

    def close(self) -> None:
        pass


def _late(start: int, part: pd.DataFrame) -> pd.DataFrame:
    n = len(part)
    nothing = [None] * n
    return pd.DataFrame(
        {"kind": ["late"] * n, "window_start": [start] * n, "feature": nothing, "n": nothing, "s": nothing, "counts": nothing, "row": part["row"].tolist()}
    )


def drift_with_late_rows(
    rows: DataFrame, frozen: DataFrame, keys: list[str], windows: str, late: str, checkpoint: str, ts: str = "date_time", seconds: int = 86_400,
    delay: str = "1 hour", features: list[str] | None = None,
) -> StreamingQuery:
    """Write closed windows with their index to ``windows`` and rows of windows that had closed to ``late`` (window_start and the row).

    ``keys`` salt the rows; ``seconds`` is the length of a window, which starts at a multiple of it.
    """
    features = features or drift.FEATURES
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    edges = {r["feature"]: list(r["edges"]) for r in frozen.select("feature", "edges").collect()}
    timed = rows.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    # A plain number of seconds: the engine drops rows behind the watermark itself only where it sees the time column.
    start = (F.floor(F.unix_micros("_at") / 1_000_000 / seconds) * seconds).cast("bigint").alias("window_start")
    salted = timed.select(
        start,
        F.pmod(F.xxhash64(*keys), F.lit(SALTS)).alias("salt"),
        *[F.col(f).cast("double").alias(f) for f in features],
        F.to_json(F.struct(*rows.columns)).alias("row"),
    )
    counted = salted.groupBy("window_start", "salt").transformWithStateInPandas(
        WindowCounts(features, edges, seconds), outputStructType=OUT, outputMode="Append", timeMode="EventTime"
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            write_batch(index_of(held.where("kind = 'window'"), frozen, seconds), windows, batch_id)
            write_batch(held.where("kind = 'late'").select(_time("window_start"), "row"), late, batch_id)
        finally:
            held.unpersist()

    return counted.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _time(seconds: str, later: int = 0) -> Column:
    return F.timestamp_seconds(F.col(seconds) + later).cast("timestamp_ntz").alias(seconds)


def index_of(parts: DataFrame, frozen: DataFrame, seconds: int) -> DataFrame:
    """Parts of windows (window_start, feature, n, s, counts) added up and judged against the frozen profile."""
    bins = [F.sum(F.col("counts")[k]).alias(f"_c{k}") for k in range(drift.BINS)]
    summed = parts.groupBy("window_start", "feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), *bins)
    profile = summed.withColumn("counts", F.array(*[f"_c{k}" for k in range(drift.BINS)]))
    scored = profile.join(F.broadcast(frozen), "feature").withColumn("psi", drift.psi_value())
    return scored.select(
        _time("window_start"),
        _time("window_start", seconds).alias("window_end"),
        "feature",
        F.col("n").alias("records"),
        (F.col("s") / F.col("n")).alias("current_mean"),
        "psi",
        drift.drift_level(F.col("psi")).alias("drift_level"),
        F.when(F.col("psi") >= drift.ALERT, "ALERT").otherwise("PASS").alias("feature_status"),
    )
