"""Conversation repair against trying every edit, and against a search from the end for longer conversations."""

import hashlib
import random
import re
import zlib
from itertools import product


from kerbline.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, edit string"
LEGAL = re.compile(r"(s?(ua)+)?")
ROLES = ["user", "assistant", "system", "tool", "", "user2"]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_edit(rows):
    """Cheapest cost and edits of all scripts with up to two insertions in a place."""
    marks, best = faults(rows), None
    gaps = [()] + [(x,) for x in "ua"] + list(product("ua", repeat=2))
    for script in product(*[[("D", 2, "")] + ([] if m in ("blank", "duplicate") else [("K", 0, r[1][:1]), ("R", 1, "u"), ("R", 1, "a")]) for r, m in zip(rows, marks)]):
        for added in product(gaps, repeat=len(rows) + 1):
            edits, letters, cost = "", "", 0
            for k, more in enumerate(added):
                edits, letters, cost = edits + "I" * len(more), letters + "".join(more), cost + 5 * len(more)
                if k < len(rows):
                    op, price, letter = script[k]
                    edits, letters, cost = edits + op, letters + letter, cost + price + (5 if op != "D" and marks[k] == "truncated" else 0)
                    if op == "K" and letter not in ("s", "u", "a"):
                        letters += "x"
            if LEGAL.fullmatch(letters) and (best is None or (cost, edits) < best):
                best = (cost, edits)
    return best


def from_the_end(rows):
    """The same by the cheapest rest of each place and last role; first edits differ, so the least first edit is the least string."""
    marks = faults(rows)
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    table = {}
    for k in range(len(rows), -1, -1):
        for last in ("u", "", "s", "a"):
            ways = [(0, "")] if k == len(rows) and last in ("", "a") else []
            if k < len(rows):
                ways.append((2 + table[k + 1, last][0], "D" + table[k + 1, last][1]))
                if marks[k] not in ("blank", "duplicate"):
                    own, more = rows[k][1][:1], 5 if marks[k] == "truncated" else 0
                    if own == due[last] or (own == "s" and last == ""):
                        ways.append((more + table[k + 1, own][0], "K" + table[k + 1, own][1]))
                    if own != due[last]:
                        ways.append((more + 1 + table[k + 1, due[last]][0], "R" + table[k + 1, due[last]][1]))
            table[k, last] = min(ways) if ways else (10**9, "")
        for _ in range(3):
            for last in ("", "s", "u", "a"):
                cost, rest = table[k, due[last]]
                table[k, last] = min(table[k, last], (cost + 5, "I" + rest))
    return table[0, ""]


def repaired_text(rows, edits):
    out, k, letters = [], 0, ""
    for edit in edits:
        role, text = ("", "") if edit == "I" else rows[k][1:]
        k += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if letters.endswith("u") else "user"
        out.append(f"{role}:{text}")
        letters += role[:1]
    assert LEGAL.fullmatch(letters)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows, search):
    rows = ordered(rows)
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, edits = search(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [marks.count(m) for m in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, repaired_text(rows, edits))


def conversation(rng, n, turns=6):
    texts = ["Yes.", "No", " \n", "Why? ", "More words here!"]
    return [(rng.choice([None, *range(turns)]), rng.choice(ROLES[: rng.choice((2, 3, 6))]), rng.choice(texts)) for _ in range(n)]


def found(spark, conversations, ids=None):
    data = [(i, *r, "clash") for i, rows in zip(ids or range(len(conversations)), conversations) for r in rows]
    out = repair.digests(repair.repair(spark.createDataFrame(data, SCHEMA))).collect()
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def test_search_from_the_end_equals_every_edit():
    rng = random.Random(1)
    for _ in range(150):
        rows = ordered(conversation(rng, rng.randint(0, 2)))
        assert from_the_end(rows) == every_edit(rows)
    for _ in range(4):
        rows = ordered(conversation(rng, 3))
        assert from_the_end(rows) == every_edit(rows)


def test_repair_equals_the_search_from_the_end(spark):
    rng = random.Random(2)
    conversations = [conversation(rng, rng.randint(1, 9)) for _ in range(300)] + [conversation(rng, 60, 200) for _ in range(20)]
    assert found(spark, conversations) == {k: expected(rows, from_the_end) for k, rows in enumerate(conversations)}


def test_long_conversation_and_copies(spark):
    rng = random.Random(4)
    long = [(k, rng.choice(ROLES), f"Turn {k} " + rng.choice(["ends.", "does not end"])) for k in range(4000)]
    copies = [(1, "user", "Same words.")] * 3000 + [(2, "assistant", "An answer."), (3, "user", "Same words.")]
    huge = [(0, "user", "word " * 300_000), (1, "assistant", "ok.")]
    conversations = [long, copies, huge, [(None, "user", "Hello."), (None, "assistant", "Yes.")]]
    assert found(spark, conversations, [5, 6, 7, None]) == dict(zip([5, 6, 7, None], [expected(r, from_the_end) for r in conversations]))


def test_survivors_share_their_past():
    """Memory follows the unresolved steps: a clean conversation never holds more than a few nodes."""
    search, most = repair.Search(), 0
    for k in range(2000):
        list(search.row(k, "ua"[k % 2], "Words.", False))
        nodes, level = 0, [search.root]
        while level:
            nodes, level = nodes + len(level), [x for n in level for x in n.below]
        most = max(most, nodes)
    assert most < 40


def test_nulls_empty_tables_and_remaining_turns(spark):
    data = [(1, None, None, "No role.", "x"), (1, 2, "user", None, "x"), (1, 3, "user", "Ask?", "x"), (2, 0, "user", "Ask?", "x")]
    edits = repair.repair(spark.createDataFrame(data, SCHEMA))
    rows = {1: [(None, " ", "No role."), (2, "user", " "), (3, "user", "Ask?")], 2: [(0, "user", "Ask?")]}
    assert {r["conv_id"]: tuple(r)[1:] for r in repair.digests(edits).collect()} == {k: expected(v, from_the_end) for k, v in rows.items()}
    remaining = [tuple(r)[1:] for r in repair.repaired(edits).filter("conv_id = 1").collect()]
    assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in remaining).encode()).hexdigest() == expected(rows[1], from_the_end)[-1]
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.digests(repair.repair(empty)).count() == 0
    assert repair.digests(repair.repair(repair.damage(empty))).count() == 0


def test_damage(spark):
    data = [(c, t, "assistant", "One. Two!", "x") for c in range(40) for t in range(3)] + [(None, None, None, None, "x")]
    found = {(r["conv_id"], r["turn"]): (r["role"], r["text"], r["copies"]) for r in repair.damage(spark.createDataFrame(data, SCHEMA)).collect()}
    shown = {0: ("", "", 0), 1: ("assistant", "", 1), 2: ("assistant", "One Two", 1), 3: ("assistant", "One. Two!", 2), 4: ("user", "One. Two!", 1)}
    for c, t, *_ in data[:-1]:
        assert found[c, t] == shown.get(zlib.crc32(f"{c}:{t}".encode()) % 20, ("assistant", "One. Two!", 1))
    assert found[None, None][2] in (0, 1, 2)
