"""Cross-tokenizer alignment: token groups of two tokenizers over the same bytes, found by galloping intersection.

1. A task encodes whole texts by both tokenizers, without special tokens, and turns token byte lengths into two ascending
   lists of byte ends. Texts of a run stand one behind the other, so the lists of a run are two lists as well.
2. Galloping intersection: the list of fewer ends drives. Each of its ends starts where an earlier one came to rest in
   the longer list, doubles its step until it is past, and finishes by binary search. The ends are taken in rounds of
   halving stride, so that all searches of a round are array operations; the steps add up to those of one end after
   the other.
3. Ends found in both lists cut the tokens into groups. The ranks give each driving token the tokens of the other list
   that it overlaps: from the rank of the end before it to its own.
4. Links are the pairs of tokens that end together. Their numbers over the corpus are summed by Spark, map-side first; the
   table of id pairs is broadcast only while it is counted small, else joined by shuffle, where a frequent pair is split
   by adaptive execution.

Tokenizer files are read by each worker from the folder given, which every machine needs; none is copied.

Defined cases: null and empty texts have no tokens. Neither has a text whose tokens do not spell a space and the text (for
instance one that holds the mark the second tokenizer uses for spaces): its counts are 0 and its digest is empty. Null and
repeated ids and repeated rows stay rows of their own, and each adds to the counts. Other columns are ignored. An empty
table gives an empty result. A text is held by one task at a time, with its tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import land, pieces, small_batches
from kerbline.shared import saved, sized

FOLDER = "/opt/tokenizers"
#: Names of the tokenizer files.
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Fixed value: how byte-level tokenizers of this kind part a text before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space of this length in one run is left to the slower of two equal encoders.
LONG_SPACE = 10_000
_ENDLESS = re.compile(rf"\s{{{LONG_SPACE}}}")
#: Id pairs that may be broadcast, about 40 bytes each.
PAIR_ROWS = 1_000_000


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """How many values of ``long`` are below each value of ``short``; both ascend."""
    rank = np.zeros(len(short), np.int64)
    if not len(short) or not len(long):
        return rank
    rank[:1] = _onwards(long, short[:1], rank[:1])
    stride = 1 << (len(short) - 1).bit_length()
    while stride > 1:
        stride //= 2
        at = np.arange(stride, len(short), 2 * stride)
        rank[at] = _onwards(long, short[at], rank[at - stride])
    return rank


def _onwards(long: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Ranks that are not below ``start``: steps of 1, 2, 4, ... until past the value, then halving."""
    last = len(long) - 1
    low, high = start.copy(), start.copy()
    going = np.flatnonzero((high <= last) & (long[np.minimum(high, last)] < values))
    step = 1
    while len(going):
        low[going] = high[going] + 1
        high[going] += step
        step *= 2
        going = going[(high[going] <= last) & (long[np.minimum(high[going], last)] < values[going])]
    high = np.minimum(high, last + 1)
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        below = long[middle] < values[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of every id, one after the other, and their lengths."""

    spelled: pa.Array
    lengths: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        return cls(pa.array(tokens, pa.large_binary()), np.array([len(t) for t in tokens], np.int64))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        data = self.spelled.take(pa.array(ids)).buffers()[2]
        return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


@dataclass(frozen=True)
class Aligned:
    """Two token lists over a run of texts: ids, first token of each text (and the end), and the groups.

    ``a_stop[g]`` and ``b_stop[g]`` are the tokens behind group ``g``; ``groups`` are the first groups of the texts.
    ``low`` and ``high`` bound the tokens of the longer list that each token of the driving one overlaps.
    """

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    a_stop: np.ndarray
    b_stop: np.ndarray
    groups: np.ndarray
    low: np.ndarray
    high: np.ndarray
    a_drives: bool


def intersect(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> Aligned:
    """Align two token lists of equal bytes; ``a_len`` and ``b_len`` are the byte lengths of their tokens."""
    a_ends, b_ends = np.cumsum(a_len), np.cumsum(b_len)
    a_drives = len(a) <= len(b)
    short, long = (a_ends, b_ends) if a_drives else (b_ends, a_ends)
    rank = gallop(short, long)
    met = long[np.minimum(rank, max(0, len(long) - 1))] == short if len(short) else np.zeros(0, bool)
    driver, other = np.flatnonzero(met) + 1, rank[met] + 1
    a_stop, b_stop = (driver, other) if a_drives else (other, driver)
    low = np.concatenate([[0], (rank + met)[:-1]]).astype(np.int64)[: len(short)]
    return Aligned(a, b, a_first, b_first, a_stop, b_stop, np.searchsorted(a_stop, a_first, side="right"), low, rank + 1, a_drives)


class Encoders:
    """The two tokenizers of a folder, each used by one thread."""

    def __init__(self, folder: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(f"{folder}/{BYTE_LEVEL}")
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
        names = self.first.get_vocab()
        spelled = [b""] * (1 + max(names.values()))
        for name, k in names.items():
            spelled[k] = _spelled(name)
        self.a = Vocabulary.of(spelled)
        self.ranked = _ranked(json.loads(self.first.to_str())["model"])
        self.b = Vocabulary.of([self._piece(k) for k in range(self.second.get_piece_size())])

    def _piece(self, k: int) -> bytes:
        piece = self.second.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(k) else piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> Aligned:
        """Both encodings of the texts; empty ones and those whose tokens spell something else have no tokens."""
        full = [t for t in texts if t]
        b = iter(self.second.encode(full, num_threads=1) if full else [])
        ids = [(np.array(self.first_ids(" " + t), np.int32), np.array(next(b), np.int32)) if t else (_NONE, _NONE) for t in texts]
        ids = [pair if t and self._spells(pair, t) else (_NONE, _NONE) for pair, t in zip(ids, texts)]
        a, b = (np.concatenate([_NONE, *side]) for side in zip(*ids))
        a_first, b_first = (np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64) for side in zip(*ids))
        return intersect(a, b, a_first, b_first, self.a.lengths[a], self.b.lengths[b])

    def first_ids(self, text: str) -> list[int]:
        """Ids of the byte-level tokenizer. Its vocabulary by ranks is several times as fast, but fails on endless white space."""
        if self.ranked is None or (len(text) > LONG_SPACE and _ENDLESS.search(text)):
            return self.first.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def _spells(self, pair: tuple[np.ndarray, np.ndarray], text: str) -> bool:
        told = np.frombuffer(b" " + text.encode(), np.uint8)
        return all(np.array_equal(told, v.bytes_of(ids)) for v, ids in zip((self.a, self.b), pair))


_NONE = np.zeros(0, np.int32)


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """Byte of each letter of the byte-level alphabet: printable Latin-1 stands for itself, the rest from 256 upwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def _spelled(name: str) -> bytes:
    byte = byte_letters()
    return bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()


def _ranked(model: dict):
    """The same encoder by ranks, where merges are in the order of the ids they give; else None."""
    import tiktoken

    names, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    first = len(names) - len(merges)
    if any(names.get("".join(m)) != first + k for k, m in enumerate(merges)):
        return None
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={_spelled(n): k for n, k in names.items()}, special_tokens={})


@lru_cache(maxsize=2)
def encoders(folder: str) -> Encoders:
    return Encoders(folder)


@lru_cache(maxsize=2)
def _marked(a_size: int, b_size: int) -> pa.Array:
    """Ids as text with what follows them in a listing of groups: A ids before , and |, B ids before , and ;"""
    return pa.array([f"{k}{mark}" for n, marks in ((a_size, ",|"), (b_size, ",;")) for mark in marks for k in range(n)], pa.large_string())


def group_listings(run: Aligned, a_size: int, b_size: int) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3`` in decimal ids."""
    kind_a, kind_b = run.a.astype(np.int64), run.b.astype(np.int64) + 2 * a_size
    kind_a[run.a_stop - 1] += a_size
    kind_b[run.b_stop - 1] += b_size
    # A token goes behind those of the other list in earlier groups (A) or up to its own group (B).
    a_group = np.searchsorted(run.a_stop, np.arange(len(run.a)), side="right")
    b_group = np.searchsorted(run.b_stop, np.arange(len(run.b)), side="right")
    b_before = np.concatenate([[0], run.b_stop])[a_group]
    listed = np.empty(len(run.a) + len(run.b), np.int64)
    listed[np.arange(len(run.a)) + b_before] = kind_a
    listed[np.arange(len(run.b)) + run.a_stop[b_group]] = kind_b
    texts = _marked(a_size, b_size).take(pa.array(listed))
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(listed) + 1]
    data = memoryview(data) if data else memoryview(b"")
    cuts = bounds[run.a_first + run.b_first]
    return [bytes(data[a : max(a, b - 1)]) for a, b in zip(cuts[:-1], cuts[1:])]


#: Columns that ``align`` can return besides those carried. Stops, low and high count tokens from the start of the text.
OUTPUTS = {
    "n_a": T.LongType(),
    "n_b": T.LongType(),
    "n_groups": T.LongType(),
    "groups_sha256": T.StringType(),
    "links": T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])),
    "a_ids": T.ArrayType(T.IntegerType()),
    "b_ids": T.ArrayType(T.IntegerType()),
    "a_stop": T.ArrayType(T.LongType()),
    "b_stop": T.ArrayType(T.LongType()),
    "a_drives": T.BooleanType(),
    "low": T.ArrayType(T.LongType()),
    "high": T.ArrayType(T.LongType()),
}
DIGEST = ["n_a", "n_b", "n_groups", "groups_sha256", "links"]


def align(docs: DataFrame, carry: list[str], outputs: list[str] = DIGEST, folder: str = FOLDER) -> DataFrame:
    """``carry`` columns of ``docs`` (text) with chosen ``OUTPUTS``.

    ``links`` holds the distinct id pairs that end together in the text and how often; ``a_stop`` and ``b_stop`` are the
    group ends; ``low`` to ``high`` (exclusive) are the tokens of the other list that each token of the driving one overlaps.
    """
    small_batches(docs.sparkSession)
    frame = docs.select(*carry, F.col("text").alias("_text"))
    schema = T.StructType([*frame.schema.fields[:-1], *[T.StructField(c, OUTPUTS[c]) for c in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = encoders(folder)
        for batch in batches:
            for rows, _, _ in pieces(batch, "_text"):
                texts = rows.column(len(carry)).to_pylist()
                found = tools.align([t or "" for t in texts])
                columns = [_output(c, found, tools) for c in outputs]
                yield pa.RecordBatch.from_arrays([*[rows.column(k) for k in range(len(carry))], *columns], names=[*carry, *outputs])

    return frame.mapInArrow(run, schema)


def _output(name: str, run: Aligned, tools: Encoders) -> pa.Array:
    a_size, b_size = len(tools.a.lengths), len(tools.b.lengths)
    driving = run.a_first if run.a_drives else run.b_first
    longer = run.b_first if run.a_drives else run.a_first
    match name:
        case "n_a":
            return pa.array(np.diff(run.a_first))
        case "n_b":
            return pa.array(np.diff(run.b_first))
        case "n_groups":
            return pa.array(np.diff(run.groups))
        case "groups_sha256":
            return pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in group_listings(run, a_size, b_size)], pa.string())
        case "links":
            return _links(run, b_size)
        case "a_ids":
            return _lists(run.a, run.a_first)
        case "b_ids":
            return _lists(run.b, run.b_first)
        case "a_stop":
            return _lists(run.a_stop - np.repeat(run.a_first[:-1], np.diff(run.groups)), run.groups)
        case "b_stop":
            return _lists(run.b_stop - np.repeat(run.b_first[:-1], np.diff(run.groups)), run.groups)
        case "a_drives":
            return pa.array([run.a_drives] * (len(run.a_first) - 1))
        case _:
            bound = run.low if name == "low" else run.high
            return _lists(bound - np.repeat(longer[:-1], np.diff(driving)), driving)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _links(run: Aligned, b_size: int) -> pa.ListArray:
    pairs = run.a[run.a_stop - 1].astype(np.int64) * b_size + run.b[run.b_stop - 1]
    counted = [np.unique(pairs[x:y], return_counts=True) for x, y in zip(run.groups[:-1], run.groups[1:])]
    keys = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in counted]])
    copies = np.concatenate([np.zeros(0, np.int64), *[n for _, n in counted]])
    bounds = np.concatenate([[0], np.cumsum([len(k) for k, _ in counted])])
    parts = [pa.array((keys // b_size).astype(np.int32)), pa.array((keys % b_size).astype(np.int32)), pa.array(copies)]
    return _lists(pa.StructArray.from_arrays(parts, names=["a", "b", "n"]), bounds)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``links`` of all rows to a, b, total (links of that id pair) and best (no pair of the same ``b`` has more)."""
    totals = saved(aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("total")))
    # One row for each id of the second vocabulary at most.
    highest = totals.groupBy(F.col("b").alias("_b")).agg(F.max("total").alias("_most"))
    return totals.join(sized(highest), F.col("b") == F.col("_b")).select("a", "b", "total", (F.col("total") == F.col("_most")).alias("best"))


def link_strength(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("place"), "text")
    aligned = land(align(own, ["doc_id", "place"], folder=folder), "aligned")
    known = sized(pair_counts(aligned), PAIR_ROWS)
    sums = (
        aligned.select("place", F.inline("links"))
        .join(known, ["a", "b"])
        .groupBy("place")
        .agg(
            F.sum("n").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("total")).alias("count_sum"),
        )
    )
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return aligned.join(sums, "place", "left").select("doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256")
