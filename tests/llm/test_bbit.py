"""Near groups by b-bit signatures against brute force over all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from llm_rows import rows

from kerbline.llm import bbit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**6))
    return " ".join(words)


def shingle_sets(texts):
    out = []
    for text in texts:
        w = WORD.findall((text or "").translate(LOWER))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_force(texts, ids=None):
    sets = shingle_sets(texts)
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= bbit.PERCENT * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return {i: (len(s), g, i == g) for i, (s, g) in enumerate(zip(sets, group))}


def found(spark, texts):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in bbit.near_groups(rows(spark, texts)).collect()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    frame = prose(rng, 150)
    texts = [prose(rng, rng.randint(20, 200)) for _ in range(25)]
    for base in texts[:8]:
        texts += [edited(rng, base, k) for k in (0, 1, 1, 2, 3)] + [base.upper(), base + " " + prose(rng, 6)]
    texts += [frame + " " + prose(rng, 60) for _ in range(12)]  # alike, below the bound
    base = prose(rng, 300)
    texts += [edited(rng, base, 4) for _ in range(40)]  # each near the base or some others, not near all
    texts += [None, "", " \t\n", "one two", "One  Two", "one two three", "a b c d e f g h i j k", "a b c d e f g h i j l", "ab " * 400, "ß" * 500]
    return texts + [prose(rng, 20_000)]


def test_groups_equal_brute_force(spark, corpus):
    assert found(spark, corpus) == brute_force(corpus)


def test_the_rest_finds_what_leaders_miss(spark, corpus, monkeypatch):
    """Without the leaders' links, and with blocks of a few members and shingles, the result is the same."""
    monkeypatch.setattr(bbit, "led_pairs", lambda classes, members: classes.selectExpr("rep AS a", "rep AS b").limit(0))
    monkeypatch.setattr(bbit, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(bbit, "BLOCK_SHINGLES", 900)
    assert found(spark, corpus) == brute_force(corpus)


def test_null_and_repeated_ids(spark):
    text = prose(random.Random(1), 40)
    docs = rows(spark, [text, text, text, "other words that are long enough", None, "another text with the id seven"], [7, 7, None, None, None, 7])
    out = sorted(map(str, (tuple(r) for r in bbit.near_groups(docs).collect())))
    n = len(shingle_sets([text])[0])
    assert out == sorted(map(str, [(7, n, 7, True), (7, n, 7, True), (None, n, 7, False), (None, 2, None, True), (None, 0, None, True), (7, 2, 7, True)]))
    assert bbit.near_groups(rows(spark, [])).count() == 0
    assert bbit.near_groups(rows(spark, [None, ""])).filter("kept").count() == 2


def test_signatures_and_estimates(spark):
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for likeness in (0.3, 0.6, 0.85, 1.0):
        both = int(4000 * likeness)
        rest = (4000 - both) // 2
        sides = [np.concatenate([shared[:both], rng.integers(0, 2**63, rest).astype(np.uint64)]) for _ in range(2)]
        least = bbit.minima(np.concatenate(sides), np.array([0, len(sides[0])]))
        signed = bbit.planes(least)
        places = int(bbit.places_with(signed, 0, np.array([1]))[0])
        bits = [sum((int(v) >> 0) & 15 == (int(w) >> 0) & 15 for v, w in zip(*bbit.mixed(least)))]
        assert places == bits[0]
        assert abs(bbit.estimate(places) - both / (both + 2 * rest)) < 0.15
        row = spark.createDataFrame([(signed[0].tolist(), signed[1].tolist())], "x array<bigint>, y array<bigint>")
        assert row.select(bbit.places_of("x", "y")).first()[0] == places
    keys = bbit.bands(least)
    assert keys.shape == (2, bbit.BANDS) and (keys[0] == keys[1]).all()


def test_no_pair_leaves_a_block_of_copies(spark):
    """The forest of m members alike has m - 1 edges."""
    rng = random.Random(9)
    base = prose(rng, 200)
    docs = rows(spark, [edited(rng, base, 1) for _ in range(60)])
    signed = bbit.described(docs, ["doc_id"], True).toArrow()
    table = signed.append_column("rep", signed.column("doc_id")).append_column("comp", signed.column("doc_id"))
    edges = bbit.forest(table.append_column("band", [[1] * 60]))
    assert edges.num_rows == 59


def test_connected_in_one_block_and_in_many(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(350)] + [(5000, 5000), (7, 9)]
    group = {x: x for e in edges for x in e if e[0] != e[1]}
    for a, b in edges * 2:
        if a != b:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {x: new if g == old else g for x, g in group.items()}
    for block in (10**6, 60):
        monkeypatch.setattr(bbit, "BLOCK_EDGES", block)
        found = bbit.connected(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
        assert len(found) == len(group) and {r["node"]: r["component"] for r in found} == group
