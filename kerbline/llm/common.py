"""Helpers of the corpus operators: reading columns, landing tables, bytes and word hashes of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.shared import fresh_path, setting

#: Text handled at once inside a task, in bytes; a longer text is handled alone.
PIECE_BYTES = 1 << 18
BATCH_ROWS = 1000
#: With this a statement removes the shuffle files of its plan when it ends, not some time after the driver's next garbage collection.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte but letters and digits parts words too.
_PLAIN = np.ones(256, bool)
_PLAIN[128:] = False
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_SLOTS = np.array(
    [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F],
    dtype=np.uint64,
)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most BATCH_ROWS rows, so that a worker's memory follows the texts, not 10,000 of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str, scratch: str | None = None) -> DataFrame:
    """Write a table to the shared folder, or a folder in it, and read it back, so that a lost executor costs a read at most.

    What was shuffled for it goes at once.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{scratch}/{run_name(name)}" if scratch else fresh_path(spark, name)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder in the shared one for tables that only the block needs; it is removed at the end.

    What leaves the block must have been landed outside of the folder.
    """
    folder = fresh_path(spark, name)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_sample(df: DataFrame, key, rows: int) -> DataFrame:
    """About ``rows`` rows by the hash of a key, never more: the share follows from a count, so no task sends many rows."""
    total = df.count()
    places = 1 << 30
    kept = df if total <= rows else df.filter(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(places)) < int(places * rows / total))
    return kept.orderBy(F.xxhash64(key)).limit(rows)


def crc_mod(column: str, n: int):
    """crc32 of the number as text, modulo n; -1 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n, F.lit(-1)).cast("int")


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` text bytes, with the bytes and the offsets of each row in them; null is empty."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = column.slice(start, stop - start)
        offsets = np.concatenate([[0], ends[start:stop] - before])
        yield batch.slice(start, stop - start), text_bytes(part), offsets
        start = stop


def text_bytes(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if "string" in str(column.type) else b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= _MIX[0]
    h ^= h >> np.uint64(29)
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    return h


def word_hashes(data: np.ndarray, offsets: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash and first byte of each word (runs of other bytes than white space, A-Z lower-cased), and the word
    offsets of each text. A word never crosses the end of its text. ``plain``: ASCII punctuation parts words too."""
    none = np.zeros(len(offsets), np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), none
    space = (_PLAIN if plain else _SPACE)[data]
    opens = np.empty(len(data), bool)
    opens[0] = True
    opens[1:] = space[:-1]
    opens[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(opens & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, none
    spans = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    powers = np.multiply.accumulate(np.full(int(spans.max()), _MULTIPLIER, np.uint64))
    values = (_LOWER[data[starts[0] :]].astype(np.uint64) + np.uint64(1)) * powers[place]
    values[space[starts[0] :]] = 0
    return mixed(np.add.reduceat(values, starts - starts[0])), starts, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of each run of ``size`` words; runs that cross two texts are for the caller to leave out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _SLOTS[k]
    return mixed(total)


def short_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole text of fewer words than a shingle."""
    total = (words * _SLOTS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
    return mixed(np.array([total ^ np.uint64(0x5851F42D4C957F2D)], np.uint64))[0]


def run_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"
