"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of lower-cased letters and digits. An item is the multiset of its five-word shingles (one of the
whole item if shorter); a shingle found in k items of different words weighs 1/k, so phrases that many items share count
less and an item listed twice counts like one listed once. A document
window with as many words as the item, or the whole document where it has fewer, is compared with it: similarity is the
sum of the smaller weights over the sum of the larger ones, and ``MIN_SIMILARITY`` or more is a leak.

Windows are found by 128-bit SimHash. Sixteen blocks of eight bits index the items: two fingerprints within ``RADIUS``
bits differ by at most RADIUS // 16 bits in some block, so the union of the blocks' near values holds every item within
the radius. Its members are checked by Hamming distance and then exactly. At the smallest similarity that counts
fingerprints differ by 22 bits on average with a deviation of 4.3, so a radius of 40 is four deviations away. Only windows that
hold a shingle of some item are fingerprinted, since any other has similarity 0.

The items are the stated reference set. They are held in tasks in blocks of at most ``BLOCK_BYTES`` of text; a larger
benchmark takes one pass over the documents' tasks per block, in the same job and without a shuffle. The weights are
counted over the whole benchmark before, and fingerprints are summed in integers, so the blocks never change a result.
Weights below 1 (12 bytes for each shingle that items share) are held whole by the driver and by each task.

Defined cases: null or empty texts, in documents or items, leak nothing; items of fewer than five words match equal
sequences of words; repeated items are each reported; a null id is a row like any other; other columns pass untouched; empty
tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import _SLOTS, SHINGLE_WORDS, mixed, pieces, shingle_hashes, small_batches, word_hashes

MIN_SIMILARITY = 0.75
BITS, BLOCKS, RADIUS = 128, 16, 40
BLOCK_BYTES = 4 << 20
#: A weight of 1 in the sums behind a fingerprint.
UNIT = 1 << 12
_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint8)
FOUND = "array<struct<item_id:bigint,similarity:double,start_word:bigint,words:int>>"


def sign_bits(shingles: np.ndarray) -> np.ndarray:
    """Rows of 128 signs, one row per shingle."""
    halves = np.stack([mixed(shingles ^ np.uint64(0x243F6A8885A308D3)), mixed(shingles ^ np.uint64(0x13198A2E03707344))], axis=1)
    return np.unpackbits(halves.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


class Weights:
    """Weight of each shingle: 1/k of those that k items share, 1 of any other."""

    def __init__(self, shingles: np.ndarray, items: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.items = shingles[order], items[order].astype(np.int32)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        out = np.ones(len(shingles))
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            known = self.shingles[at] == shingles
            out[known] = 1 / self.items[at[known]]
        return out


def units(weights: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.rint(weights * UNIT)).astype(np.int32)


class Items:
    """Index of a bounded block of benchmark items."""

    def __init__(self, ids: list[int | None], texts: list[str | None], weigh: Weights):
        self.ids, self.bags, prints, self.sizes = [], [], [], []
        self.short: dict[int, dict[int, list[int | None]]] = {}
        known = []
        for item_id, text in zip(ids, texts):
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _, _ = word_hashes(data, np.array([0, len(data)]), plain=True)
            if len(words) >= SHINGLE_WORDS:
                known.append((item_id, len(words), shingle_hashes(words)))
            elif len(words):
                self.short.setdefault(len(words), {}).setdefault(int(run_hashes(words, len(words))[0]), []).append(item_id)
        self.weight, self.totals = {}, []
        for item_id, size, shingles in known:
            weights = weigh(shingles)
            self.ids.append(item_id)
            self.sizes.append(size)
            self.bags.append(Counter(shingles.tolist()))
            self.totals.append(float(weights.sum()))
            self.weight.update(zip(shingles.tolist(), weights.tolist()))
            prints.append(np.packbits(units(weights) @ sign_bits(shingles) > 0))
        self.vocabulary = np.array(sorted(self.weight), np.uint64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.by_size = {}
        for size in sorted(set(self.sizes)):
            members = np.array([i for i, s in enumerate(self.sizes) if s == size])
            self.by_size[size] = (members, np.stack([prints[i] for i in members]), near_values(np.stack([prints[i] for i in members])))

    def similarity(self, item: int, window: np.ndarray, weights: np.ndarray) -> float:
        a, b = self.bags[item], Counter(window.tolist())
        both = sum(self.weight[x] * min(n, b[x]) for x, n in a.items() if x in b)
        return both / (self.totals[item] + float(weights.sum()) - both)

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places of shingles that occur in an item."""
        maybe = np.flatnonzero(self.filter[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
        return maybe[np.isin(shingles[maybe], self.vocabulary)] if len(maybe) else maybe

    def search(self, words: np.ndarray, shingles: np.ndarray, hits: np.ndarray, weigh: Weights) -> list[tuple]:
        """Best window of each leaked item: (item_id, similarity, first word, number of words)."""
        best: dict[int, tuple] = {}
        for low, high in regions(hits, max(self.by_size) - SHINGLE_WORDS, len(shingles)):
            part = shingles[low:high]
            weights = weigh(part)
            totals = np.zeros((len(part) + 1, BITS), np.int32)
            np.cumsum(sign_bits(part) * units(weights)[:, None], axis=0, out=totals[1:])
            held = np.zeros(len(part) + 1, np.int32)
            inside = hits[(hits >= low) & (hits < high)] - low
            held[inside + 1] = 1
            held = np.cumsum(held)
            for size, (members, prints, near) in self.by_size.items():
                # A region is shorter than an item only if it is the whole document, which then is the only window.
                span = min(size - SHINGLE_WORDS + 1, len(part))
                starts = np.flatnonzero(held[span:] - held[:-span] > 0)
                if not len(starts):
                    continue
                windows = np.packbits(totals[starts + span] - totals[starts] > 0, axis=1)
                found = near[0, windows[:, 0]]
                for block in range(1, BLOCKS):
                    found = found | near[block, windows[:, block]]
                rows, columns = np.nonzero(np.unpackbits(found, axis=1, count=len(members)))
                close = _ONES[windows[rows] ^ prints[columns]].sum(axis=1) <= RADIUS
                for row, column in zip(rows[close], columns[close]):
                    item, at = int(members[column]), int(starts[row])
                    likeness = self.similarity(item, part[at : at + span], weights[at : at + span])
                    if likeness >= MIN_SIMILARITY and likeness > best.get(item, (0, 0.0))[1]:
                        best[item] = (self.ids[item], likeness, low + at, span + SHINGLE_WORDS - 1)
        out = [best[i] for i in sorted(best)]
        for size, known in self.short.items():
            for at, h in enumerate(run_hashes(words, size).tolist()):
                out += [(item_id, 1.0, at, size) for item_id in known.get(h, ())]
        return out


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _SLOTS[k]
    return mixed(total + np.uint64(size))


def near_values(prints: np.ndarray) -> np.ndarray:
    """For each block and byte value, the items (packed bits) whose byte is within RADIUS // BLOCKS bits of it."""
    value = np.arange(256, dtype=np.uint8)
    close = _ONES[prints.T[:, None, :] ^ value[None, :, None]] <= RADIUS // BLOCKS
    return np.packbits(close, axis=2)


def regions(hits: np.ndarray, reach: int, n: int) -> Iterator[tuple[int, int]]:
    """Runs of shingles that hold every window over a hit; hits further apart than two windows are parted."""
    cuts = np.flatnonzero(np.diff(hits) > 2 * reach + 2) + 1
    for run in np.split(hits, cuts):
        yield max(0, int(run[0]) - reach), min(n, int(run[-1]) + reach + 1)


def shared_weights(benchmark: DataFrame) -> Weights:
    """Weights from the number of items that hold a shingle; items of the same words are one."""
    small_batches(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch, "text"):
                words, _, bounds = word_hashes(data, offsets, plain=True)
                runs = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.md5(x.tobytes()).digest() for x in runs], pa.binary()),
                        pa.array([np.unique(shingle_hashes(x)).view(np.int64) for x in runs], pa.list_(pa.int64())),
                    ],
                    names=["words", "shingles"],
                )

    texts = benchmark.select(F.lower("text").alias("text")).distinct().mapInArrow(run, "words binary, shingles array<bigint>")
    counts = texts.dropDuplicates(["words"]).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("items"))
    known = counts.filter("items > 1").toArrow()
    return Weights(known.column("shingle").to_numpy().view(np.uint64), known.column("items").to_numpy())


def item_blocks(benchmark: DataFrame, weigh: Weights) -> Iterator[Items]:
    """The benchmark in blocks of at most BLOCK_BYTES of text on average, one on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.lower("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        yield Items([r["item_id"] for r in rows], [r["text"] for r in rows], weigh)


def _one_pass(frame: DataFrame, items: Items, weights: Broadcast) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(items)
    found_type = pa.list_(
        pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("words", pa.int32())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weigh = shared.value, weights.value
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                words, _, bounds = word_hashes(data, offsets, plain=True)
                shingles = shingle_hashes(words)
                hits = index.hits(shingles)
                ends = np.searchsorted(hits, bounds)
                found = rows.column("found").to_pylist()
                for d in range(rows.num_rows):
                    first, last = int(bounds[d]), int(bounds[d + 1])
                    own = hits[ends[d] : ends[d + 1]]
                    own = own[own + SHINGLE_WORDS <= last] - first
                    if len(own) or index.short:
                        mine = shingles[first : max(first, last - SHINGLE_WORDS + 1)]
                        found[d] = found[d] + [
                            {"item_id": a, "similarity": b, "start_word": c, "words": e}
                            for a, b, c, e in (index.search(words[first:last], mine, own, weigh) if len(own) else short_only(index, words[first:last]))
                        ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row"), rows.column("text"), pa.array(found, found_type)], names=["row", "text", "found"]
                )

    return frame.mapInArrow(run, T.StructType([frame.schema[c] for c in ("row", "text", "found")]))


def short_only(index: Items, words: np.ndarray) -> list[tuple]:
    return [
        (item_id, 1.0, at, size)
        for size, known in index.short.items()
        for at, h in enumerate(run_hashes(words, size).tolist())
        for item_id in known.get(h, ())
    ]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``row`` with ``found``: the items it leaks, best window of each."""
    frame = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lower("text").alias("text"), F.array().cast(FOUND).alias("found")
    )
    weigh = shared_weights(benchmark)
    weights = docs.sparkSession.sparkContext.broadcast(weigh)
    searched = reduce(lambda rows, items: _one_pass(rows, items, weights), item_blocks(benchmark, weigh), frame)
    return searched.select("row", F.array_sort("found").alias("found"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they are."""
    return leaks(docs, benchmark).filter(F.size("found") == 0).select("row.*")
