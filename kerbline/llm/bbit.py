"""MinHash near-duplicates by b-bit signatures: bands for candidates, bit counts for estimates, whole sets for the verdict.

1. A task turns each whole text into its set of five-word shingle hashes, its digest, ``HASHES`` minima, ``BANDS`` keys of
   ``ROWS`` minima each, and the low ``BITS`` bits of the minima, packed as bit planes of 64-bit words. Texts of equal sets
   are one class, combined before the shuffle.
2. Band keys that classes share are buckets. An estimate takes the places where all planes agree, by bit counts, less the chance
   agreements of unequal minima: (p - 2^-b) / (1 - 2^-b). Pairs estimated below ``CUTOFF`` are not looked at.
3. Leaders: each bucket names its most shared class, and each class is confirmed against the likeliest of its leaders only. That is
   linear in the rows, and joins large groups of near copies.
4. The rest: buckets that still hold two components. In blocks of bounded size a search through the estimates yields a spanning
   forest of the pairs between components, at most one edge a member. Trees of it meet with their whole sets, in blocks of
   bounded size again, and links that join two components are confirmed by inverted lists, the most similar classes first.
5. Components of all links are the result. Links are exact on 64-bit shingle hashes.

What bands can miss: a pair of likeness s shares no band with probability (1 - s^ROWS)^BANDS, 6e-11 at 0.85; the estimate of such a pair
is below the cutoff with probability 5e-10. A bucket of m classes that are not alike costs m^2 / 2 bit counts of
64 bytes, spread over blocks of chunk pairs; no pair of them leaves its block.

Defined cases: null and empty texts, and texts without words, have an empty set, stand alone and are kept; fewer words than
five are one shingle; a null id takes the component of its equals, else null, and is kept only then; a repeated id is
counted with each of its texts; repeated rows are repeated in the result; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.llm.common import SHINGLE_WORDS, land, mixed, pieces, shingle_hashes, short_hash, small_batches, word_hashes
from kerbline.llm.graph import components
from kerbline.shared import sized

PERCENT = 85
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
CUTOFF = 0.6
WORDS = HASHES // 64
#: Agreeing places of a pair that is at the cutoff.
LEAST_PLACES = int(np.ceil(HASHES * (CUTOFF + (1 - CUTOFF) * 2.0**-BITS)))
#: Members of a block of signatures, and shingles of a block of sets; a block of several small groups holds about as much.
BLOCK_MEMBERS, BLOCK_SHINGLES = 4096, 1_000_000
#: Edges whose components one task finds.
BLOCK_EDGES = 1_000_000

_seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FLIPS, FACTORS = _seeds[:HASHES], _seeds[HASHES:] | np.uint64(1)


def minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least value under each hash of the shingles from each start to the next: one row a set."""
    out = np.empty((len(starts), HASHES), np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((shingles ^ FLIPS[k]) * FACTORS[k], starts)
    return out


def planes(least: np.ndarray) -> np.ndarray:
    """Low bits of the minima: for each bit a plane of ``WORDS`` words, which hold a place a bit."""
    low = mixed(least)
    rows = [np.packbits((low >> np.uint64(k)) & np.uint64(1) > 0, axis=1).view(np.int64) for k in range(BITS)]
    return np.concatenate(rows, axis=1) if len(least) else np.zeros((0, BITS * WORDS), np.int64)


def bands(least: np.ndarray) -> np.ndarray:
    grouped = least.reshape(len(least), BANDS, ROWS)
    total = np.tile(np.arange(BANDS, dtype=np.uint64), (len(least), 1))
    for k in range(ROWS):
        total = mixed(total + grouped[:, :, k])
    return total.view(np.int64)


def estimate(places):
    """Likeness of two sets, given the places where all their planes agree."""
    return (places / HASHES - 2.0**-BITS) / (1 - 2.0**-BITS)


def places_of(one: str, other: str) -> Column:
    """Agreeing places of two columns of planes."""
    differ = [
        " | ".join(f"({one}[{p * WORDS + w}] ^ {other}[{p * WORDS + w}])" for p in range(BITS))
        for w in range(WORDS)
    ]
    return F.expr(f"{HASHES} - " + " - ".join(f"bit_count({d})" for d in differ))


def places_with(signatures: np.ndarray, row: int, others: np.ndarray) -> np.ndarray:
    """The same of one row of signatures with others."""
    differ = (signatures[others] ^ signatures[row]).reshape(len(others), BITS, WORDS)
    # Of a negative number numpy counts the bits of its absolute value.
    return HASHES - np.bitwise_count(np.bitwise_or.reduce(differ, axis=1).view(np.uint64)).sum(axis=1, dtype=np.int64)


def described(docs: DataFrame, carry: list[str], signature: bool) -> DataFrame:
    """``carry`` columns with n_shingles and key (digest of the set), and planes and bands, or else the sorted set as tokens."""
    small_batches(docs.sparkSession)
    frame = docs.select(*carry, F.col("text").alias("_text"))
    longs = T.ArrayType(T.LongType())
    names = ["planes", "bands"] if signature else ["tokens"]
    schema = T.StructType(
        [*frame.schema.fields[:-1], T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()), *[T.StructField(n, longs) for n in names]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, "_text"):
                sets = _sets(data, offsets)
                sizes = np.array([len(s) for s in sets], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                values = np.concatenate(sets)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                lists = [_equal_lists(x, sizes > 0) for x in _signatures(values, bounds[:-1][sizes > 0])] if signature else [_lists(values.view(np.int64), bounds)]
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(k) for k in range(len(carry))], pa.array(sizes), pa.array(keys, pa.binary()), *lists],
                    names=[*carry, "n_shingles", "key", *names],
                )

    return frame.mapInArrow(run, schema)


def _sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    words, _, bounds = word_hashes(data, offsets)
    shingles = shingle_hashes(words)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            out.append(np.zeros(0, np.uint64))
        elif b - a < SHINGLE_WORDS:
            out.append(np.array([short_hash(words[a:b])]))
        else:
            own = np.sort(shingles[a : b - SHINGLE_WORDS + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
    return out


def _signatures(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    least = minima(values, starts) if len(starts) else np.zeros((0, HASHES), np.uint64)
    return planes(least), bands(least)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _equal_lists(rows: np.ndarray, filled: np.ndarray) -> pa.ListArray:
    """A list for each filled place, none for the others."""
    return _lists(rows.ravel(), np.concatenate([[0], np.cumsum(filled * rows.shape[1])]))


def classes_of(rows: DataFrame) -> DataFrame:
    known = rows.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    return known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("planes").alias("planes"), F.first("bands").alias("bands"))


def buckets(classes: DataFrame) -> DataFrame:
    """Band keys of more than one class: band, rep, size."""
    dealt = classes.select("rep", F.explode("bands").alias("band"))
    sizes = dealt.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    return dealt.join(sizes, "band")


def led_pairs(classes: DataFrame, members: DataFrame) -> DataFrame:
    """Each class with the likeliest leader of its buckets, if one is above the cutoff: a, b."""
    # A class has at most as many rows here as there are bands.
    shared = members.groupBy("rep").agg(F.sum("size").alias("shared"), F.collect_list("band").alias("own"))
    lead = F.max(F.struct("shared", (-F.col("rep")).alias("less")))
    leaders = shared.select("rep", "shared", F.explode("own").alias("band")).groupBy("band").agg((-lead["less"]).alias("b"))
    pairs = members.join(leaders, "band").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    signed = [classes.select(F.col("rep").alias(c), F.col("planes").alias(f"planes_{c}")) for c in ("a", "b")]
    judged = pairs.join(signed[0], "a").join(signed[1], "b").select("a", "b", places_of("planes_a", "planes_b").alias("places"))
    best = F.max(F.struct("places", (-F.col("b")).alias("less")))
    return judged.filter(F.col("places") >= LEAST_PLACES).groupBy("a").agg((-best["less"]).alias("b"))


def whole_sets(docs: DataFrame, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """Sets of the classes that ``reps`` (rep) name, read again from their text: rep, tokens."""
    chosen = sized(classes.select("rep", F.col("key").alias("_key")).join(reps, "rep", "left_semi"))
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(chosen, "rep")
    return described(texts, ["rep", "_key"], False).filter(F.col("key") == F.col("_key")).dropDuplicates(["rep", "key"]).select("rep", "tokens")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose whole sets are alike enough. A leader of many pairs is one key, which adaptive execution splits."""
    sided = [sets.select(F.col("rep").alias(c), F.col("tokens").alias(f"tokens_{c}")) for c in ("a", "b")]
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - both
    return pairs.join(sided[0], "a").join(sided[1], "b").filter(100 * both >= PERCENT * union).select("a", "b")


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` (a, b) to (node, component), the least node reachable.

    Edges are dealt evenly into blocks of at most about ``BLOCK_EDGES``. A block keeps, of its part of the graph, an edge from each node
    to the least one it reaches. Where there are several blocks, rounds over those edges finish the work.
    """
    edges = land(edges.filter("a <> b").distinct(), name)
    blocks = 1 + edges.count() // BLOCK_EDGES
    dealt = edges.withColumn("block", F.pmod(F.xxhash64("a", "b"), F.lit(blocks)))
    hung = dealt.groupBy("block").applyInArrow(least_reached, "a bigint, b bigint")
    if blocks > 1:
        return components(hung, name)
    named = hung.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.union(named.select("component", "component").distinct())


def least_reached(table: pa.Table) -> pa.Table:
    """Each node of a block of edges, but the least of its component, with that one."""
    a, b = (table.column(c).to_numpy() for c in ("a", "b"))
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        moved = label.copy()
        for side in (x, y, label[x], label[y]):
            np.minimum.at(moved, side, low)
        moved = moved[moved]
        if (moved == label).all():
            break
        label = moved
    hung = label != np.arange(len(nodes))
    return pa.table({"a": nodes[hung], "b": nodes[label[hung]]})


def meeting(rows: DataFrame, group: str, weight: Column, limit: int) -> DataFrame:
    """``rows`` with the block they meet in (part, one, two): small groups share parts, and a group above the limit is cut into
    chunks by ``rep``, each pair of which is a block."""
    weights = land(rows.groupBy(group).agg(F.sum(weight).alias("weight")), "weights")
    total = weights.agg(F.sum("weight")).first()[0] or 0
    small, large = (weights.filter(c).drop("weight") for c in (f"weight <= {limit}", f"weight > {limit}"))
    shared = rows.join(small, group).select(
        *rows.columns, F.pmod(F.xxhash64(group), F.lit(int(1 + total // limit))).alias("part"), F.lit(0).alias("one"), F.lit(0).alias("two")
    )
    chunks = F.ceil(F.col("weight") / F.lit(limit / 2)).cast("int")
    cut = rows.join(weights.filter(f"weight > {limit}").select(group, chunks.alias("_chunks")), group)
    own = cut.withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda k: k != F.col("_own")))
    paired = own.withColumn("_other", other).select(
        *rows.columns, F.xxhash64(group).alias("part"), (F.least("_own", "_other") + 1).alias("one"), (F.greatest("_own", "_other") + 1).alias("two")
    )
    return shared.union(paired)


def _groups(table: pa.Table, group: str) -> Iterator[np.ndarray]:
    values = table.column(group).to_numpy()
    order = np.argsort(values, kind="stable")
    yield from (g for g in np.split(order, np.flatnonzero(np.diff(values[order])) + 1) if len(g) > 1)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [c.flatten().to_numpy() for c in column.chunks]
    return np.concatenate([np.zeros(0, np.int64), *parts]).reshape(-1, width)


def forest(table: pa.Table) -> pa.Table:
    """Edges that span the pairs of a bucket above the cutoff and between components; at most one edge a member."""
    reps, comps = table.column("rep").to_numpy(), table.column("comp").to_numpy()
    signatures = _matrix(table.column("planes"), BITS * WORDS)
    edges = []
    for group in _groups(table, "band"):
        if (comps[group] == comps[group[0]]).all():
            continue
        unseen = group
        while len(unseen):
            reached, unseen = [unseen[0]], unseen[1:]
            while reached and len(unseen):
                x = reached.pop()
                near = (comps[unseen] != comps[x]) & (places_with(signatures, x, unseen) >= LEAST_PLACES)
                found, unseen = unseen[near], unseen[~near]
                edges += [(reps[x], reps[y]) for y in found]
                reached += found.tolist()
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def spanning_links(table: pa.Table) -> pa.Table:
    """Links between components of a block, exact: none that adds no connection is looked for."""
    reps, comps = table.column("rep").to_numpy(), table.column("comp").to_numpy().copy()
    signatures = _matrix(table.column("planes"), BITS * WORDS)
    column = table.column("tokens").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    ends, tokens = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
    links = []
    for group in _groups(table, "tree"):
        sets = [tokens[ends[i] : ends[i + 1]] for i in group]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(group)), sizes)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        # Rows that agree most with the others are likely to link them all.
        everyone = np.arange(len(group))
        own = signatures[group]
        likeness = [int(places_with(own, x, everyone).sum()) for x in everyone]
        for x in np.argsort(likeness, kind="stable")[::-1]:
            apart = np.flatnonzero(comps[group] != comps[group[x]])
            apart = apart[places_with(own, x, apart) >= LEAST_PLACES]
            if not len(apart):
                continue
            low, high = np.searchsorted(values, sets[x]), np.searchsorted(values, sets[x], side="right")
            spans = high - low
            at = np.repeat(low - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            both = np.bincount(owner[at], minlength=len(group))[apart]
            for y in apart[100 * both >= PERCENT * (sizes[x] + sizes[apart] - both)]:
                if comps[group[x]] != comps[group[y]]:
                    links.append((reps[group[x]], reps[group[y]]))
                    comps[comps == comps[group[y]]] = comps[group[x]]
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def remaining_links(docs: DataFrame, classes: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the components in ``labels`` (node, component) that buckets can still show."""
    named = labels.select(F.col("node").alias("rep"), F.col("component").alias("_comp"))
    held = land(members.select("band", "rep").join(named, "rep", "left").select("band", "rep", F.coalesce("_comp", "rep").alias("comp")), "members")
    unlike = held.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("band")
    open_ = held.join(unlike, "band").join(classes.select("rep", "planes"), "rep")
    edges = land(meeting(open_, "band", F.lit(1), BLOCK_MEMBERS).groupBy("part", "one", "two").applyInArrow(forest, "a bigint, b bigint"), "edges")
    trees = connected(edges, "trees").select(F.col("node").alias("rep"), F.col("component").alias("tree"))
    comps = held.groupBy("rep").agg(F.first("comp").alias("comp"))
    trees = land(trees.join(comps, "rep").join(classes.select("rep", "planes"), "rep"), "trees")
    sets = land(trees.join(whole_sets(docs, trees, classes), "rep"), "tree-sets")
    blocks = meeting(sets, "tree", F.size("tokens").cast("bigint"), BLOCK_SHINGLES)
    return blocks.groupBy("part", "one", "two").applyInArrow(spanning_links, "a bigint, b bigint")


def near_groups(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, n_shingles, component_id (least id its links reach) and kept."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = land(described(source, ["doc_id"], True), "signatures")
    classes = land(classes_of(rows), "classes")
    members = land(buckets(classes), "buckets")
    pairs = land(led_pairs(classes, members), "led")
    involved = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()
    links = land(confirmed(pairs, land(whole_sets(source, involved, classes), "sets")), "links")
    rest = land(remaining_links(source, classes, members, land(connected(links, "led"), "labels")), "rest")
    labels = connected(links.union(rest), "linked").withColumnRenamed("node", "rep")
    named = classes.select("key", "rep").join(labels, "rep", "left").select("key", F.coalesce("component", "rep").alias("linked"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("linked"))
    return rows.select("doc_id", "n_shingles", "key").join(named, "key", "left").select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )
