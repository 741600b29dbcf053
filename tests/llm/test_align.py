"""Token alignment against a plain version that compares sets of byte ends text by text."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import rows

from kerbline.llm import align

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "  two  spaces\n\n\ttabs and\r\nline ends ",
    "Größenwahn, façade, naïve: 日本語のテキスト \U0001f600\U0001f680 ½ ﬁ",
    "a mark ▁ that spells a space",
    "<|endoftext|> <s> </s> <unk> <0x41> are text here",
    None,
    "",
    " ",
    "\x00 control \x07",
    "the the the the the",
    "The quick brown fox jumps over the lazy dog.",
    "ß" * 3000,
    "word salad " * 4000,
    "wide" + " " * 300_000 + "space",
]


def brute_force(texts):
    tools = align.encoders(align.FOLDER)
    byte = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    byte.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if chr(b) not in byte)})

    def second(k):
        piece = tools.second.id_to_piece(k)
        return bytes.fromhex(piece[3:5]) if tools.second.is_byte(k) else piece.replace("▁", " ").encode()

    found = []
    for text in texts:
        full = b" " + (text or "").encode()
        a = tools.first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = tools.second.encode(text) if text else []
        a_bytes = [bytes(byte[c] for c in tools.first.id_to_token(k)) for k in a]
        b_bytes = [second(k) for k in b]
        if b"".join(a_bytes) != full or b"".join(b_bytes) != full:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends = {len(b"".join(a_bytes[: k + 1])): k for k in range(len(a))} if len(a) < 500 else dict(zip(np.cumsum([len(x) for x in a_bytes]).tolist(), range(len(a))))
        b_ends = dict(zip(np.cumsum([len(x) for x in b_bytes]).tolist(), range(len(b))))
        both = sorted(set(a_ends) & set(b_ends))
        found.append((a, b, [(a_ends[e], b_ends[e]) for e in both]))
    counts = Counter((a[i], b[j]) for a, b, links in found for i, j in links)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for a, b, links in found:
        told, i, j = [], 0, 0
        for x, y in links:
            told.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            i, j = x + 1, y + 1
        held = [counts[a[x], b[y]] for x, y in links]
        best = sum(n == most[b[y]] for n, (_, y) in zip(held, links))
        out.append((len(a), len(b), len(links), len(links), best, sum(held), hashlib.sha256(";".join(told).encode()).hexdigest() if a else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_alignment_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(align, "PAIR_ROWS", 0)
    found = align.link_strength(rows(spark, TEXTS)).collect()
    expected = brute_force(TEXTS)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found} == dict(enumerate(expected))
    assert expected[3][:2] == (0, 0) and expected[0][2] > 5


def test_null_and_repeated_ids_stay_rows(spark):
    texts = ["same text here", "same text here", "other", None]
    found = align.link_strength(rows(spark, texts, [7, 7, None, None])).collect()
    expected = brute_force(texts)
    assert sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in found) == sorted((i, *e) for i, e in zip(["7", "7", "None", "None"], expected))
    assert align.link_strength(rows(spark, [])).count() == 0


def test_stops_and_overlaps_of_each_text(spark):
    outputs = ["a_ids", "b_ids", "a_stop", "b_stop", "a_drives", "low", "high"]
    docs = rows(spark, TEXTS).withColumnRenamed("n_chars", "my col")
    tools = align.encoders(align.FOLDER)
    for row in align.align(docs, ["doc_id", "my col"], outputs).collect():
        ends = [np.cumsum(v.lengths[row[c]]) if row[c] else np.zeros(0, int) for c, v in (("a_ids", tools.a), ("b_ids", tools.b))]
        assert ends[0][np.array(row["a_stop"], int) - 1].tolist() == ends[1][np.array(row["b_stop"], int) - 1].tolist()
        driver, other = ends if row["a_drives"] else ends[::-1]
        for k, (low, high) in enumerate(zip(row["low"], row["high"])):
            start, stop = (driver[k - 1] if k else 0), driver[k]
            touched = [j for j in range(len(other)) if other[j] > start and (other[j - 1] if j else 0) < stop]
            if k > 200:
                break
            assert touched == list(range(low, high))


def test_gallop_counts_smaller_values():
    rng = np.random.default_rng(3)
    for n, m in ((0, 4), (4, 0), (1, 1), (30, 900), (500, 500), (3, 20000)):
        short, long = (np.sort(rng.choice(30000, k, replace=False)) for k in (n, m))
        assert align.gallop(short, long).tolist() == [int((long < x).sum()) for x in short]
