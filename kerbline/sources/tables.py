"""Reading and writing tables, reports and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from kerbline.errors import DataError
from kerbline.operators.quality import require_columns
from kerbline.sources.fixture import RAW_COLUMNS

CORRUPT = "_corrupt"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_scan_raw(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Text landing of the raw CSV: every column a string, unreadable lines kept in ``_corrupt``.

    A blank cell is a missing value, quoted or not.
    """
    columns = columns or RAW_COLUMNS
    schema = text_schema(columns).add(CORRUPT, T.StringType())
    try:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", False)
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path)
        )
    except AnalysisException as error:
        raise DataError(f"input could not be read: {path}") from error


def read_table(spark: SparkSession, path: str, required: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """A processed table reduced to the columns a consumer asked for."""
    try:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        df = reader.load(path)
    except AnalysisException as error:
        raise DataError(f"input could not be read: {path}") from error
    return require_columns(df, required).select(*required) if required else df


def register(df: DataFrame, name: str = "traffic") -> str:
    df.createOrReplaceTempView(name)
    return name


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(path)
    except AnalysisException as error:
        raise DataError(f"table could not be written: {path}") from error
    return path


def write_report(df: DataFrame, folder: str, name: str, fmt: str = "csv") -> str:
    """One folder per report; written by the executors whatever its size."""
    return write_table(df, f"{folder}/{name}", fmt)


def write_lines(lines: DataFrame, path: str) -> str:
    """Small (line_no, line) tables as one ordered text file."""
    lines.orderBy("line_no").coalesce(1).select(F.col("line")).write.mode("overwrite").text(path)
    return path
