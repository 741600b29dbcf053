"""CSV whose quoted cells hold line breaks, read in parallel.

A line break ends a record only outside quotes, so where a block of a file begins inside quotes is known from the quotes before
it. One scan counts the quotes of each block; their parities are summed along each file, a row for each block. A
second scan cuts its lines into records, block by block in file order, without moving them. Only the pieces of records that
cross a block's end are shuffled, two for a block at most, and put together.

Defined cases: doubled quotes inside a cell are two quotes and change nothing; carriage returns before a line break that
ends a record are dropped, inside quotes they stay; empty lines outside quotes are left out; the first record of each
file is its header; a quote that is never closed makes one record of the rest of its file, which lands in ``_corrupt`` as
other unreadable records do. Files need no order, and a compressed file is one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.errors import DataError
from kerbline.shared import saved
from kerbline.sources.fixture import RAW_COLUMNS
from kerbline.sources.tables import CORRUPT

PIECES = "file string, block bigint, kind string, first boolean, record string"
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("first", pa.bool_()), ("record", pa.string())])
#: A record inside its block; the end of one that began before it; the start of one that ends behind it; neither.
WHOLE, HEAD, TAIL, MIDDLE = "whole", "head", "tail", "middle"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the start of the block they are in, in file order inside a block, and whether their quotes are odd."""
    try:
        lines = spark.read.option("lineSep", "\n").text(path)
    except AnalysisException as error:
        raise DataError(f"input could not be read: {path}") from error
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", (quotes % 2 == 1).alias("odd")
    )


def open_blocks(lines: DataFrame) -> DataFrame:
    """Blocks (file, block) that begin inside quotes."""
    blocks = lines.groupBy("file", "block").agg((F.count_if("odd") % 2).alias("parity"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("open", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1).where("open").select("file", "block", "open")


def pieces_of(lines: DataFrame) -> DataFrame:
    """Records and pieces of records, each in the block it is in."""
    # A row for a block of the file system at most, and only for those that begin inside quotes.
    marked = lines.join(F.broadcast(saved(open_blocks(lines))), ["file", "block"], "left")
    marked = marked.select("file", "block", F.coalesce("open", F.lit(False)).alias("open"), "odd", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Block()
        for batch in batches:
            out = []
            for part in _runs(batch):
                own = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                if own != state.own:
                    out += state.ended()
                    state = _Block(own, part.column(2)[0].as_py())
                out += state.lines(part.column(4), part.column(3).to_numpy(zero_copy_only=False))
            if out:
                yield pa.RecordBatch.from_pylist(out, _PIECES)
        if rest := state.ended():
            yield pa.RecordBatch.from_pylist(rest, _PIECES)

    return marked.mapInArrow(run, PIECES)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that lie in one block."""
    if not batch.num_rows:
        return
    block = batch.column(1).to_numpy()
    file = batch.column(0).dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)


class _Block:
    """The lines of one block, cut into records as they come."""

    def __init__(self, own: tuple[str, int] | None = None, inside: bool = False) -> None:
        self.own, self.inside, self.held = own, inside, []
        self.kind = HEAD if inside else WHOLE
        self.first = own is not None and own[1] == 0

    def lines(self, values: pa.Array, odd: np.ndarray) -> list[dict]:
        out = []
        for value, turns in zip(values.to_pylist(), odd):
            self.held.append(value)
            self.inside ^= bool(turns)
            if not self.inside:
                out.append(self._piece(self.kind))
                self.kind = WHOLE
        return out

    def ended(self) -> list[dict]:
        if not self.held:
            return []
        return [self._piece(MIDDLE if self.kind == HEAD else TAIL)]

    def _piece(self, kind: str) -> dict:
        record, self.held = "\n".join(self.held), []
        piece = {"file": self.own[0], "block": self.own[1], "kind": kind, "first": self.first and kind in (WHOLE, TAIL), "record": record}
        self.first = self.first and kind not in (WHOLE, TAIL)
        return piece


def csv_records(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Text landing of CSV with line breaks in quotes: every column a string, unreadable records in ``_corrupt``."""
    pieces = pieces_of(lines_of(spark, path))
    whole = pieces.where(F.col("kind") == WHOLE).select("first", "record")
    parts = pieces.where(F.col("kind") != WHOLE)
    so_far = Window.partitionBy("file").orderBy("block", F.col("kind") == TAIL).rowsBetween(Window.unboundedPreceding, 0)
    begun = parts.withColumn("begin", F.last(F.when(F.col("kind") == TAIL, F.col("block")), ignorenulls=True).over(so_far))
    joined = begun.groupBy("file", "begin").agg(
        F.max("first").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), "\n").alias("record")
    )
    records = whole.unionByName(joined.select("first", "record")).where("NOT first").select(F.regexp_replace("record", "\r$", "").alias("record"))
    schema = ", ".join(f"`{c}` string" for c in [*(columns or RAW_COLUMNS), CORRUPT])
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
    filled = records.where(F.trim("record") != "")
    return filled.select(F.from_csv("record", schema, options).alias("r")).select("r.*")
