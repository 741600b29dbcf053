"""Cleaned and feature tables written once per session, as the boundary between batch stages."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.operators.cleaning import clean
from kerbline.operators.features import engineer
from kerbline.shared import shared_folder
from kerbline.sources.fixture import KEY, traffic_raw

done: set[str] = set()


def path_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/{tag}/{name}"


def in_time_order(table: DataFrame) -> DataFrame:
    """Sort inside each file, without a shuffle, so that row-group bounds serve time filters."""
    return table.sortWithinPartitions("date_time", *KEY)


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table."""
    path = path_of(spark, sf_dir, "traffic")
    if path not in done:
        in_time_order(clean(traffic_raw(spark, sf_dir))).write.mode("overwrite").parquet(path)
        done.add(path)
    return spark.read.parquet(path)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the source category beside its flags, and ``weather`` as its alias."""
    path = path_of(spark, sf_dir, "features")
    if path not in done:
        table = engineer(traffic(spark, sf_dir), keep_source=True)
        in_time_order(table).write.mode("overwrite").parquet(path)
        done.add(path)
    return spark.read.parquet(path).withColumn("weather", F.col("weather_main"))
