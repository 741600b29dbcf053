"""Removal of repeated passages: every byte covered by a 400-byte string that starts at two places or more.

1. Each 400-byte window has a minimizer, the smallest hash of its 32-byte strings, so equal windows have equal
   minimizers. Runs of windows with one minimizer are segments (start, length, content hash); a text is a few segments
   per kilobyte, and equal texts are counted once before anything is exchanged.
2. Segments are counted by minimizer and content. A content seen twice is repeated as a whole. A minimizer with a single segment,
   and no second occurrence inside it, has no repeated window. Only minimizers with several contents, or with
   a repeat inside one, go on.
3. Those segments, one of each content, meet in blocks of bounded size by minimizer. A block is searched by
   threshold-bounded interval expansion on its Burrows-Wheeler transform (``bwt``), exactly, by the bytes.
   A minimizer with more than ``CROWD`` contents (an edge of a passage that very many documents share) would make a
   block too large. Its segments are parted again by the minimizers of ever longer strings, the last of whole windows:
   a part seen twice is repeated, one whose minimizer has no other part is not, and only the rest is parted further.
4. Repeated runs go back to each text's segments and are cut out of the whole texts.

Content hashes are 64-bit and compared together with the minimizer and the length. All intermediate tables follow the number
of segments, and the large ones go as soon as what follows from them is landed; texts are read again rather than shuffled, but
for those of step 3. Lists of segments or runs go to all tasks only while their rows and their entries together are few, else
by a shuffle join; one list is bounded by its own text.

Defined cases: null and empty texts lose nothing; texts under 400 bytes lose nothing; equal texts of 400 bytes or more
lose everything; null ids are rows like any other; repeated rows are equal texts; other columns pass untouched;
an empty table gives an empty result. Cuts may fall inside a character: the kept bytes are exact, and as
text a cut character is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kerbline.llm.bwt import SEPARATOR, repeated
from kerbline.llm.common import PIECE_BYTES, land, mixed, pieces, scratch_folder
from kerbline.shared import sized

LEAST = 400
GRAM = 32
WINDOW = LEAST - GRAM + 1
BLOCK_BYTES = 1 << 20
CROWD = 1500
#: Windows of a crowded segment whose strings share a minimizer, over those of the next round.
NARROWER = 6
CHUNK = 1 << 23
_PLACE_BITS = np.uint64(24)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
SEGMENTS = "array<struct<v:bigint,s:bigint,n:int,h:bigint,again:boolean>>"


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial; the hash of bytes a..b is (p[b] - p[a]) / base**a, independent of a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=out[1:])
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    table = padded.reshape(blocks, width)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, minimizer, start, length, content hash, and whether the minimizer, a string of ``gram`` bytes, occurs twice in it."""
    grams, window = len(data) - gram + 1, least - gram + 1
    if grams < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int64, bool))
    sums, inverse = prefix_hashes(data), powers(_INVERSE, len(data))
    hashes = mixed((sums[gram:] - sums[:-gram]) * inverse[:grams]) >> _PLACE_BITS
    place = np.arange(grams, dtype=np.uint64)
    keyed = hashes << _PLACE_BITS
    first = sliding_min(keyed | place, window)
    last = sliding_min(keyed | (np.uint64(grams) - place), window)
    low = np.uint64((1 << 24) - 1)
    twice = (first & low) != np.uint64(grams) - (last & low)
    v = (first >> _PLACE_BITS).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[: len(v)] == row[least - 1 :]
    change = np.ones(len(v), bool)
    change[1:] = (v[1:] != v[:-1]) | (row[1 : len(v)] != row[: len(v) - 1]) | (whole[1:] != whole[:-1])
    # Occurrences ``window`` apart are never in one window, but follow one another inside a segment.
    found = first & low
    twice[1:] |= ~change[1:] & (found[1:] != found[:-1])
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(v))
    again = np.logical_or.reduceat(twice, starts)
    kept = whole[starts]
    starts, ends, again = starts[kept], ends[kept] + least - 1, again[kept]
    content = mixed((sums[ends] - sums[starts]) * inverse[starts])
    rows = row[starts]
    return rows, v[starts], starts - offsets[rows], (ends - starts).astype(np.int32), content.view(np.int64), again


def chunked(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``segments``, in overlapping chunks where one text is longer than a place can number."""
    if len(data) <= CHUNK + least:
        return segments(data, offsets, least, gram)
    parts = []
    for at in range(0, len(data) - least + 1, CHUNK):
        part = data[at : at + CHUNK + least - 1]
        rows, v, s, n, h, again = segments(part, np.array([0, len(part)]), least, gram)
        parts.append((rows, v, s + at, n, h, again))
    return tuple(np.concatenate(x) for x in zip(*parts))


def text_key() -> Column:
    return F.unhex(F.md5("text")).alias("text_key")


def with_segments(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """text_key (md5), n_bytes and segments of every text of at least ``least`` bytes."""
    frame = docs.filter(F.octet_length("text") >= least).select(text_key(), "text")
    kind = pa.struct([("v", pa.int64()), ("s", pa.int64()), ("n", pa.int32()), ("h", pa.int64()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                row, v, s, n, h, again = chunked(data, offsets, least)
                ends = np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays(
                    [pa.array(x, type=f.type) for x, f in zip((v, s, n, h, again), kind)], fields=list(kind)
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column("text_key"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(ends), values)],
                    names=["text_key", "n_bytes", "segments"],
                )

    return frame.mapInArrow(run, f"text_key binary, n_bytes bigint, segments {SEGMENTS}")


def segment_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """v, h, n and bytes of the wanted segments (text_key, s, n, v, h), from one copy of each text."""
    lists = sized(wanted.groupBy("text_key").agg(F.collect_list(F.struct("v", "s", "n", "h")).alias("wanted")), lists="wanted")
    texts = docs.select(text_key(), "text").join(lists, "text_key").dropDuplicates(["text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"v": [], "h": [], "n": [], "bytes": []}
            for text, wants in zip(batch.column(batch.schema.get_field_index("text")), batch.column(batch.schema.get_field_index("wanted"))):
                whole = text.as_py().encode()
                for w in wants.as_py():
                    for name in ("v", "h", "n"):
                        out[name].append(w[name])
                    out["bytes"].append(whole[w["s"] : w["s"] + w["n"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["v"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["bytes"], pa.binary())],
                names=["v", "h", "n", "bytes"],
            )

    return texts.select("text", "wanted").mapInArrow(run, "v bigint, h bigint, n int, bytes binary")


RUNS = "v bigint, h bigint, n int, runs array<struct<a:int,b:int>>"


def block_runs(table: pa.Table, least: int = LEAST) -> pa.Table:
    """Runs of window starts in each segment of a block whose windows occur again in the block."""
    joined, starts, at = [], [], 0
    for x in table.column("bytes"):
        data = np.frombuffer(x.as_buffer(), np.uint8)
        starts.append(at)
        joined.append(np.where(data == SEPARATOR, np.uint8(255), data))  # 255 is in no UTF-8 text
        joined.append(np.zeros(1, np.uint8))
        at += len(data) + 1
    places = repeated(np.concatenate(joined), least)
    owner = np.searchsorted(np.array(starts), places, side="right") - 1
    return runs_table(table, owner, places - np.array(starts)[owner])


def runs_table(table: pa.Table, owner: np.ndarray, place: np.ndarray) -> pa.Table:
    runs = [[] for _ in range(table.num_rows)]
    if len(owner):
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(place) != 1)]))
        for i, j in zip(fresh, np.append(fresh[1:], len(owner))):
            runs[owner[i]].append({"a": int(place[i]), "b": int(place[j - 1]) + 1})
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.table({"v": table.column("v"), "h": table.column("h"), "n": table.column("n"), "runs": pa.array(runs, kind)})


def window_hashes(data: np.ndarray, least: int) -> np.ndarray:
    sums, n = prefix_hashes(data), len(data) - least + 1
    return mixed((sums[least:] - sums[:-least]) * powers(_INVERSE, n)).view(np.int64)


def grams(least: int) -> list[int]:
    """Lengths of the strings that part crowded segments, round by round; the last are whole windows."""
    out, width = [], least - GRAM + 1
    while not out or width > 1:
        width = max(1, width // NARROWER)
        out.append(least - width + 1)
    return out


STRETCH = "v bigint, h bigint, n int, s int, m int"


def own_repeats(rows: DataFrame, least: int) -> DataFrame:
    """The windows of each segment as stretches (start s, m bytes) of which no two share a window, but for those with ``again``.

    ``again`` are windows that came before in the segment, ``settled`` all that occur in it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, out = [], {k: [] for k in ("s", "m", "settled", "again")}
            for k, x in enumerate(batch.column(batch.schema.get_field_index("bytes"))):
                hashes = window_hashes(np.frombuffer(x.as_buffer(), np.uint8), least)
                _, first, kind, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                settled, again = counts[kind] > 1, np.ones(len(hashes), bool)
                again[first] = False
                edges = np.flatnonzero((settled[1:] != settled[:-1]) | (again[1:] != again[:-1])) + 1
                starts = np.concatenate([[0], edges])
                owner.append(np.full(len(starts), k))
                for name, values in zip(out, (starts, np.diff(starts, append=len(hashes)) + least - 1, settled[starts], again[starts])):
                    out[name].append(values)
            if owner:
                part = batch.select(["v", "h", "n"]).take(pa.array(np.concatenate(owner)))
                types = (pa.int32(), pa.int32(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(np.concatenate(x), t) for x, t in zip(out.values(), types)]], names=["v", "h", "n", *out]
                )

    return rows.mapInArrow(run, f"{STRETCH}, settled boolean, again boolean")


def stretch_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """v, h, n, s, settled and bytes of each stretch of the segments, of which few share a batch where they are long."""
    owner, out, size = [], {"s": [], "settled": [], "bytes": []}, 0
    for k, (x, stretches) in enumerate(zip(batch.column("bytes"), batch.column("stretches"))):
        whole = x.as_py()
        for at in stretches.as_py():
            owner.append(k)
            for name, value in zip(out, (at["s"], at["settled"], whole[at["s"] : at["s"] + at["m"]])):
                out[name].append(value)
            size += at["m"]
            if size >= PIECE_BYTES:
                yield _stretches(batch, owner, out)
                owner, out, size = [], {name: [] for name in out}, 0
    if owner:
        yield _stretches(batch, owner, out)


def _stretches(batch: pa.RecordBatch, owner: list[int], out: dict[str, list]) -> pa.RecordBatch:
    keys = batch.select(["v", "h", "n"]).take(pa.array(owner, pa.int64()))
    types = (pa.int32(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([*keys.columns, *[pa.array(x, t) for x, t in zip(out.values(), types)]], names=["v", "h", "n", *out])


def parted(rows: DataFrame, stretches: DataFrame, least: int, gram: int) -> DataFrame:
    """The stretches parted by minimizers of ``gram`` bytes, with minimizer w and content hash c of each part."""
    lists = stretches.groupBy("v", "h", "n").agg(F.collect_list(F.struct("s", "m", "settled")).alias("stretches"))
    frame = rows.join(sized(lists, lists="stretches"), ["v", "h", "n"]).select("v", "h", "n", "bytes", "stretches")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in (x for each in stretch_bytes(batch) for x in pieces(each, "bytes")):
                if gram < least:
                    row, w, s, m, c, _ = chunked(data, offsets, least, gram)
                else:
                    row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                    at = np.flatnonzero(row[: len(row) - least + 1] == row[least - 1 :])
                    row, c = row[at], window_hashes(data, least)[at]
                    s, m, w = at - offsets[row], np.full(len(at), least), c
                taken = part.select(["v", "h", "n", "s", "settled"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[:3],
                        pa.array(taken.column(3).to_numpy() + s, pa.int32()),
                        pa.array(m, pa.int32()),
                        pa.array(w, pa.int64()),
                        pa.array(c, pa.int64()),
                        taken.column(4),
                    ],
                    names=["v", "h", "n", "s", "m", "w", "c", "settled"],
                )

    return frame.mapInArrow(run, f"{STRETCH}, w bigint, c bigint, settled boolean")


def crowd_runs(rows: DataFrame, least: int = LEAST, scratch: str | None = None) -> DataFrame:
    """The same for minimizers with too many contents, by 64-bit hashes in rounds of longer strings.

    Windows that a segment repeats itself are settled first. Then a round takes a few parts of each stretch that is left,
    not its windows: most parts lie in a passage as a whole, or share no minimizer with others.
    """
    rows = land(rows.select("v", "h", "n", "bytes"), "crowd", scratch)
    stretches = land(own_repeats(rows, least), "crowd-stretches", scratch)
    found = stretches.filter("settled").select("v", "h", "n", "s", "m")
    stretches = stretches.filter("NOT again")
    for gram in grams(least):
        parts = land(parted(rows, stretches, least, gram), "crowd-parts", scratch)
        contents = parts.groupBy("v", "w", "m", "c").agg(F.count("*").alias("seen"), F.min(F.struct("h", "n", "s", "settled")).alias("at"))
        contents = land(contents, "crowd-contents", scratch)
        shared = contents.filter("seen > 1").select("v", "w", "m", "c")
        found = found.union(parts.filter("NOT settled").join(sized(shared), ["v", "w", "m", "c"]).select("v", "h", "n", "s", "m"))
        contents = contents.select("v", "w", "m", "at", (F.col("at.settled") | (F.col("seen") > 1)).alias("settled"))
        open_ = contents.groupBy("v", "w").agg(F.count("*").alias("contents"), F.min("settled").alias("all"))
        open_ = sized(open_.filter("contents > 1 AND NOT all").select("v", "w"))
        stretches = land(contents.join(open_, ["v", "w"]).select("v", "at.h", "at.n", "at.s", "m", "settled"), "crowd-stretches", scratch)
        if stretches.isEmpty():
            break
    # Stretches of a segment share no window; those that follow one another are one run.
    places = found.select("v", "h", "n", F.col("s").alias("a"), (F.col("s") + F.col("m") - least + 1).cast("int").alias("b"))
    order = Window.partitionBy("v", "h", "n").orderBy("a")
    fresh = F.coalesce(F.col("a") != F.lag("b").over(order), F.lit(True)).cast("int")
    runs = places.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    runs = runs.groupBy("v", "h", "n", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs.groupBy("v", "h", "n").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))


def repeated_runs(docs: DataFrame, least: int = LEAST, scratch: str | None = None) -> DataFrame:
    """text_key to the sorted runs [a, b) of window starts that are repeated, for texts that have any."""
    with scratch_folder(docs.sparkSession, "segments") as first:
        texts = land(with_segments(docs, least), "segments", first)
        distinct = texts.groupBy("text_key").agg(F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first("segments").alias("segments"))
        distinct = land(distinct, "texts", scratch)
    rows = distinct.select("text_key", "copies", F.explode("segments").alias("x")).select("text_key", "copies", "x.*")
    with scratch_folder(docs.sparkSession, "contents") as first:
        contents = rows.groupBy("v", "h", "n").agg(
            F.sum("copies").alias("seen"), F.max("again").alias("again"), F.min(F.struct("text_key", "s")).alias("at")
        )
        contents = land(contents, "contents", first)
        minimizers = contents.groupBy("v").agg(F.count("*").alias("contents"), F.sum("seen").alias("total"), F.max("again").alias("inside"), F.min("seen").alias("fewest"))
        open_ = land(contents.join(minimizers.filter("total > 1 OR inside"), "v"), "open", scratch)
    wanted = open_.filter("(contents > 1 OR inside) AND fewest = 1").select("v", "h", "n", "contents", "at.text_key", "at.s")
    found = land(segment_bytes(docs, wanted), "segment-bytes", scratch)
    crowds = wanted.filter(F.col("contents") > CROWD).select("v").distinct()
    crowds = land(crowds, "crowds", scratch)
    quiet = found.join(sized(crowds), "v", "left_anti")
    total = quiet.agg(F.sum("n")).first()[0] or 0
    block = F.pmod(F.xxhash64("v"), F.lit(1 + total // BLOCK_BYTES)).alias("block")
    runs = quiet.withColumn("block", block).groupBy("block").applyInArrow(lambda found: block_runs(found, least), RUNS)
    if not crowds.isEmpty():
        runs = runs.union(crowd_runs(found.join(sized(crowds), "v", "left_semi"), least, scratch))
    complete = F.array(F.struct(F.lit(0).alias("a"), (F.col("n") - least + 1).cast("int").alias("b")))
    outcome = open_.filter("seen > 1").select("v", "h", "n", complete.alias("runs"))
    outcome = land(
        outcome.union(runs.join(open_.filter("seen = 1").select("v", "h", "n"), ["v", "h", "n"]).filter(F.size("runs") > 0)), "runs", scratch
    )
    single = rows.filter("copies = 1").select("text_key", "v", "h", "n", "s")
    spans = (
        single.join(sized(outcome, lists="runs"), ["v", "h", "n"])
        .select("text_key", F.explode(F.transform("runs", lambda r: F.struct((F.col("s") + r["a"]).alias("a"), (F.col("s") + r["b"]).alias("b")))).alias("r"))
        .groupBy("text_key")
        .agg(F.sort_array(F.collect_list("r")).alias("runs"))
    )
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), (F.col("n_bytes") - least + 1).alias("b")))
    return distinct.filter("copies > 1").select("text_key", everything.alias("runs")).union(spans)


def spans_of(runs: list[dict], least: int) -> list[tuple[int, int]]:
    """Byte ranges that the windows of sorted runs cover; runs that overlap or touch are one range."""
    spans = []
    for r in runs:
        end = r["b"] + least - 1
        if spans and r["a"] <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((r["a"], end))
    return spans


def cut(docs: DataFrame, least: int = LEAST, words: int = 0) -> DataFrame:
    """Every row as the struct ``row`` with n_bytes, n_removed, n_spans, the kept bytes and their sha256.

    Ranges of fewer than ``words`` words stay.
    """
    with scratch_folder(docs.sparkSession, "passages") as scratch:
        plan = land(repeated_runs(docs.select("text"), least, scratch), "cuts")
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"), text_key())
    frame = frame.join(sized(plan, lists="runs"), "text_key", "left").select("row", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept", "kept_text", "kept_sha256")}
            for text, runs in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode()
                spans = [(a, b) for a, b in spans_of(runs.as_py() or [], least) if not words or len(data[a:b].split()) >= words]
                stops = [0, *[b for _, b in spans]]
                kept = b"".join(data[b:a] for b, a in zip(stops, [*[a for a, _ in spans], len(data)]))
                for name, x in zip(out, (len(data), len(data) - len(kept), len(spans), kept, kept.decode(errors="ignore"), hashlib.sha256(kept).hexdigest())):
                    out[name].append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, t) for x, t in zip(out.values(), types)]], names=["row", *out]
            )

    added = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType())]
    added += [("kept_text", T.StringType()), ("kept_sha256", T.StringType())]
    return frame.mapInArrow(run, T.StructType([frame.schema["row"], *[T.StructField(*f) for f in added]]))


def without_repeats(docs: DataFrame, drop_emptied: bool = False, least: int = LEAST, words: int = 0) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and n_chars, if there, counted anew. Null stays null.

    Passages are ranges covered by repeated strings of ``least`` bytes that hold ``words`` words or more.

    A text that is repeated as a whole becomes empty; with ``drop_emptied`` rows left without a word that had any go.
    """
    kept = cut(docs, least, words)
    rows = kept.withColumn("_text", F.when(F.col("row.text").isNotNull(), F.col("kept_text")))
    if drop_emptied:
        rows = rows.filter((F.col("n_removed") == 0) | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        *[
            (F.col("_text") if c == "text" else F.length("_text").cast(t) if c == "n_chars" else F.col("row").getField(c)).alias(c)
            for c, t in docs.dtypes
        ]
    )
