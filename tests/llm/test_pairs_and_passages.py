"""Near duplicates, repeated passages and leaks against brute force, with the defined edge cases."""

import glob
import hashlib
import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from llm_rows import rows
from pyspark.sql import functions as F

from kerbline import shared
from kerbline.llm import decontam, graph, mixing, ngramjoin, spotsigs, suffixdedup
from kerbline.llm.bwt import repeated
from kerbline.llm.common import SHUFFLE_CLEANUP, land

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))


def near_copy(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**6))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    passage = prose(rng, 120)
    texts = [prose(rng, rng.randint(20, 200)) for _ in range(20)]
    for base in texts[:6]:
        texts += [near_copy(rng, base, k) for k in (0, 1, 2, 4)] + [base.upper()]
    texts += [prose(rng, 60) + " " + passage + " " + prose(rng, 60) for _ in range(5)]
    texts += [None, "", " \t\n", "one two", "One Two", "one two three", "ab " * 400, "ß" * 500, prose(rng, 4000)]
    return texts


def test_components_equal_brute_force(spark, corpus):
    sets = []
    for text in corpus:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.near_groups(rows(spark, corpus)).collect()}
    assert found == {i: (len(s), group[i]) for i, s in enumerate(sets)}
    kept = {r["doc_id"] for r in ngramjoin.one_of_each(rows(spark, corpus)).collect()}
    assert kept == set(group)


def test_large_components_are_cut_into_pairs_of_chunks(spark, corpus, monkeypatch):
    whole = sorted(map(tuple, ngramjoin.near_groups(rows(spark, corpus)).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(ngramjoin, "BLOCK_TOKENS", 300)
    assert sorted(map(tuple, ngramjoin.near_groups(rows(spark, corpus)).select("doc_id", "component_id").collect())) == whole


def test_rows_that_stay_are_shuffled_once(spark, corpus):
    with shared.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = ngramjoin.one_of_each(rows(spark, corpus))._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(_at" in line for line in plan.splitlines()) == 2  # the rows and those who stay


def test_map_of_shared_shingles_grows_with_the_documents(spark, monkeypatch):
    """A map that is full takes every shingle for a shared one."""
    monkeypatch.setattr(ngramjoin, "MAP_BITS", 9)
    docs = rows(spark, [prose(random.Random(k), 120) for k in range(60)])
    sets = ngramjoin.with_sets(docs, ["doc_id"], ngramjoin.frequencies(docs)).collect()
    assert sum(len(r["tokens"]) for r in sets) < 60
    assert [ngramjoin.map_size(n) for n in (1, 1 << 20, 3_200_000, 1 << 40)] == [9, 26, 28, 30]


def test_join_of_null_ids_and_repeated_rows(spark):
    text = "a b c d e f g h i j"
    docs = rows(spark, [text, text, text, "other words that are long enough", None], [7, 7, None, None, None])
    found = sorted(map(str, ngramjoin.near_groups(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert found == sorted(
        map(str, spark.createDataFrame([(7, 6, 7), (7, 6, 7), (None, 6, 7), (None, 2, None), (None, 0, None)], "doc_id bigint, n_shingles bigint, component_id bigint").collect())
    )
    assert ngramjoin.one_of_each(docs).count() == 3


def test_graph_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(10, 40)] + [(5, 4), (4, 5), (3, 3)], "a bigint, b bigint")
    found = dict(map(tuple, graph.components(edges).collect()))
    assert found == {**{k: 10 for k in range(10, 41)}, 5: 4, 4: 4}


def covered(texts, least):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + least] for b in data for k in range(len(b) - least + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                gone[k : k + least] = b"\1" * least
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cut_rows(spark, texts):
    found = suffixdedup.cut(rows(spark, texts)).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return [tuple(r)[1:] for r in sorted(found)]


def test_cuts_equal_brute_force(spark, corpus):
    assert cut_rows(spark, corpus) == covered(corpus, suffixdedup.LEAST)


def test_cuts_of_periods_around_the_window(spark):
    rng = random.Random(6)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n - 1)) + "\n" for n in range(suffixdedup.WINDOW - 1, suffixdedup.WINDOW + 2)]
    texts = [line * 3 for line in lines]
    expected = covered(texts, suffixdedup.LEAST)
    assert cut_rows(spark, texts) == expected and all(x[1] > 0 for x in expected)


def test_lists_are_broadcast_by_their_entries(spark, monkeypatch):
    lists = spark.createDataFrame([(1, [1, 2, 3]), (2, [4])], "k int, x array<int>")

    def hinted():
        return "Hint" in shared.sized(lists, lists="x")._jdf.queryExecution().analyzed().toString()

    assert hinted()
    monkeypatch.setattr(shared, "BROADCAST_ENTRIES", 3)
    assert not hinted()
    monkeypatch.setattr(shared, "BROADCAST_ENTRIES", 0)
    rng = random.Random(7)
    passage = prose(rng, 150)
    texts = [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(3)] + [prose(rng, 200)]
    assert cut_rows(spark, texts) == covered(texts, suffixdedup.LEAST)


def test_crowded_minimizers_give_the_same_cuts(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffixdedup, "CROWD", 2)
    assert cut_rows(spark, corpus) == covered(corpus, suffixdedup.LEAST)


def test_crowds_make_parts_not_windows(spark, monkeypatch):
    rng = random.Random(12)
    passage, line = prose(rng, 200), prose(rng, 9) + "\n"
    texts = [f"{prose(rng, 120)} {passage[rng.randrange(40) :]} {prose(rng, 120)}" for _ in range(40)]
    texts += [f"{prose(rng, k)} {passage[:600]}{chr(97 + k) * (450 + k)}{line * 12}{passage[500:]}" for k in range(20)]
    written = {}

    def counted(df, name, scratch=None):
        out = land(df, name, scratch)
        written[name] = max(out.count(), written.get(name, 0))
        return out

    land = suffixdedup.land
    monkeypatch.setattr(suffixdedup, "land", counted)
    for least in (suffixdedup.LEAST, 200):
        monkeypatch.setattr(suffixdedup, "CROWD", 2)
        written.clear()
        found = suffixdedup.cut(rows(spark, texts), least).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert [tuple(r)[1:] for r in sorted(found)] == covered(texts, least)
        most = max(n for name, n in written.items() if name.startswith("crowd"))
        assert written["crowds"] > 0 and most < 16 * written["contents"]


def test_tables_of_passages_go_once_they_are_read(spark, corpus, monkeypatch):
    there = {}

    def listed(df, name, scratch=None):
        there[name] = {run.rpartition("-")[0] for _, folders, _ in os.walk(shared.shared_folder(spark)) for run in folders if scratch and run in written}
        out = land(df, name, scratch)
        written.update(os.path.basename(os.path.dirname(path)) for path in out.inputFiles())
        return out

    written, land = set(), suffixdedup.land
    monkeypatch.setattr(suffixdedup, "land", listed)
    assert cut_rows(spark, corpus) == covered(corpus, suffixdedup.LEAST)
    assert there["texts"] == {"segments"} and there["contents"] == {"texts"}
    assert there["segment-bytes"] == {"texts", "open"}


def test_landing_leaves_no_shuffle_files(spark):
    def shuffled():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {path for folder in folders for path in glob.glob(f"{folder.getPath()}/*/shuffle_*")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP, None)
    one = land(spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).count(), "one")
    two = land(one.join(one.withColumnRenamed("count", "again").hint("merge"), "k"), "two")
    assert two.filter("count = again").count() == 7_000 and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    for _ in range(50):
        if not (left := [path for path in shuffled() - before if os.path.getsize(path) > 10_000]):
            break
        time.sleep(0.2)
    assert not left


def test_repeats_on_the_transform_equal_counting():
    rng = np.random.default_rng(2)
    for _ in range(60):
        x = rng.integers(1, rng.integers(3, 6), rng.integers(5, 300)).astype(np.uint8)
        x = np.concatenate([x, x[: rng.integers(0, len(x))]])
        x[rng.random(len(x)) < 0.03] = 0
        n = int(rng.integers(9, 30))
        seen = Counter(bytes(x[k : k + n]) for k in range(len(x) - n + 1))
        assert repeated(x, n).tolist() == [k for k in range(len(x) - n + 1) if 0 not in x[k : k + n] and seen[bytes(x[k : k + n])] > 1]


def test_text_after_cuts(spark):
    text = "é" * 300
    out = {r["doc_id"]: r for r in suffixdedup.without_repeats(rows(spark, [text + "a", "b" + text, None, ""])).collect()}
    assert [out[k]["text"] for k in range(4)] == ["a", "b", None, ""]
    assert out[0]["n_chars"] == 1 and out[0]["row"] == "clash"


def test_leaks_equal_brute_force(spark, corpus):
    rng = random.Random(9)
    items = [prose(rng, n) for n in (14, 30, 30, 59)] + ["two words", "", None]
    planted = [
        f"{prose(rng, 40)} {items[0].upper()}!! {prose(rng, 10)}",
        near_copy(rng, items[3], 1) + " " + prose(rng, 5),
        " ".join(items[1].split()[:15]),
        "these two  Words, here",
    ]
    docs = rows(spark, [*planted, *corpus])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {r["row"]["doc_id"]: sorted(x["item_id"] for x in r["found"]) for r in decontam.leaks(docs, bench).collect()}
    assert [found[k] for k in range(4)] == [[0], [3], [], [4]]
    assert not any(found[k] for k in range(4, len(found)))
    assert decontam.without_leaks(docs, bench).count() == len(corpus) + 1
    assert decontam.leaks(docs, bench.limit(0)).filter("size(found) > 0").count() == 0


def test_items_longer_than_the_document_are_found(spark):
    rng = random.Random(4)
    items = [prose(rng, 40), prose(rng, 90)]
    words = items[0].split()
    texts = [" ".join(words[:36]), " ".join(words[4:]), " ".join(words[:20] + words[21:]), " ".join(words[:20]), items[0] + " " + prose(rng, 20)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {r["row"]["doc_id"]: [tuple(x) for x in r["found"]] for r in decontam.leaks(rows(spark, texts), bench).collect()}
    assert [[x[0] for x in found[k]] for k in range(5)] == [[0], [0], [0], [], [0]]
    assert [found[k][0][2:] for k in (0, 1, 2, 4)] == [(0, 36), (0, 36), (0, 39), (0, 40)]
    assert found[0][0][1] == pytest.approx(32 / 36) and found[2][0][1] == pytest.approx(31 / 40)


def test_weights_follow_the_whole_benchmark(spark, monkeypatch):
    rng = random.Random(8)
    once, common = prose(rng, 44), prose(rng, 12)
    listed = [once, once.upper() + "!", once] + [f"{prose(rng, 30)} {common}" for _ in range(30)]
    words = once.split()
    words[20] = "changed"
    texts = [" ".join(words), f"{prose(rng, 9)} {near_copy(rng, listed[5], 2)} {prose(rng, 9)}", listed[7], prose(rng, 50), None]
    bench = spark.createDataFrame(list(enumerate(listed)), "item_id bigint, text string")

    def found():
        return sorted((r["row"]["doc_id"], [tuple(x) for x in r["found"]]) for r in decontam.leaks(rows(spark, texts), bench).collect())

    whole = found()
    assert [x[0] for x in whole[0][1]] == [0, 1, 2] and whole[0][1][0][1] == pytest.approx((40 - 5) / (40 + 5))
    assert [x[0] for x in whole[2][1]] == [7] and not whole[3][1] and not whole[4][1]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1 << 10)
    assert found() == whole


def test_fingerprints(spark, corpus):
    docs = rows(spark, corpus)
    out = {r["doc_id"]: r for r in spotsigs.edited_rows(docs).collect()}
    for i, text in enumerate(corpus):
        text, following = text or "", corpus[(i + 1) % len(corpus)] or ""
        k = len(text) // 4
        assert out[i]["edited_sha256"] == hashlib.sha256((text[: len(text) - k] + following[:k]).encode()).hexdigest()
        assert 0 <= out[i]["near_edited"] <= 1 and 0 <= out[i]["near_next"] <= 1
    assert out[0]["fingerprint"] == out[20]["fingerprint"] and out[0]["fingerprint"] != ""
    marked = spotsigs.with_fingerprint(docs.na.fill({"text": ""}), "text", "fingerprint")
    found = {(r["a"], r["b"]): r["likeness"] for r in spotsigs.near_pairs(marked).collect()}
    classes = {}
    for r in sorted(marked.select("doc_id", "fingerprint").collect()):
        classes.setdefault(r["fingerprint"], r["doc_id"])
    sets = {i: set(f.split()) for f, i in classes.items() if f}
    expected = {(a, b): len(s & t) / len(s | t) for a, s in sets.items() for b, t in sets.items() if a < b and len(s & t) >= 0.75 * len(s | t)}
    assert found == pytest.approx(expected)


def test_empty_tables(spark):
    none = rows(spark, ["x"]).limit(0)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for out in (ngramjoin.near_groups(none), ngramjoin.one_of_each(none), suffixdedup.cut(none), decontam.leaks(none, bench), spotsigs.edited_rows(none)):
        assert out.count() == 0


ODD_NAMES = ["my col", "a-b", "a.b", "row", "text_key", "key", "found", "size"]


def odd(spark, texts):
    docs = rows(spark, texts).drop("row", "token")
    for name in ODD_NAMES:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    return docs


def test_columns_with_odd_names_pass(spark, corpus):
    docs = odd(spark, corpus)
    bench = spark.createDataFrame([(1, "some words that nobody has written into any document here")], "item_id bigint, text string")
    stages = [ngramjoin.one_of_each, lambda d: suffixdedup.without_repeats(d, least=200, words=20), lambda d: decontam.without_leaks(d, bench), mixing.mix]
    for stage in stages:
        out = stage(docs)
        assert out.columns[: len(docs.columns)] == docs.columns
        kept = out.collect()
        assert kept and all(r[name] == f"{name}{r['doc_id']}" for r in kept for name in ODD_NAMES)


def test_passages_count_by_words_where_asked(spark):
    rng = random.Random(8)
    passage, short = prose(rng, 60), prose(rng, 30)
    texts = [f"{prose(rng, 40)} {passage} {prose(rng, 40)} {short} {prose(rng, 40)}" for _ in range(3)]
    kept = suffixdedup.without_repeats(rows(spark, texts), least=80, words=50).orderBy("doc_id").collect()
    for row, text in zip(kept, texts):
        assert passage not in row["text"] and short in row["text"]
        assert row["text"] == text.replace(" " + passage + " ", "")
