"""Shared storage and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.errors import DataError

BROADCAST_ROWS = 200_000
BROADCAST_ENTRIES = 1_000_000
#: Bytes of packed blocks that a task takes, so that tasks are many and alike whatever the files.
BLOCK_SPLIT = 16 << 20
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a scratch one in local mode."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    app = context.applicationId
    if not base:
        if not context.master.startswith("local"):
            raise DataError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folders.setdefault(app, tempfile.mkdtemp(prefix="kerbline-"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/kerbline-{app}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds in the block only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def block_splits(spark: SparkSession):
    """In this block, files of packed blocks are read in parts of ``BLOCK_SPLIT``."""
    return setting(spark, "spark.sql.files.maxPartitionBytes", str(BLOCK_SPLIT))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate result and cut its lineage; survives executor loss."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def attach(df: DataFrame, row: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate on every row, as a scalar subquery; null if it is empty."""
    cell = row.select(F.struct(*row.columns)).scalar()
    return df.withColumn("_row", cell).select(*df.columns, *[F.col("_row")[c].alias(c) for c in row.columns])


def sized(small: DataFrame, max_rows: int = BROADCAST_ROWS, lists: str | None = None) -> DataFrame:
    """Broadcast an aggregate only after counting it; larger ones are left to a shuffle join.

    ``lists`` names a list column, whose entries over all rows must not exceed ``BROADCAST_ENTRIES`` either.
    """
    small = saved(small)
    rows, entries = small.agg(F.count("*"), F.sum(F.size(lists)) if lists else F.lit(0)).first()
    return F.broadcast(small) if rows <= max_rows and (entries or 0) <= BROADCAST_ENTRIES else small
