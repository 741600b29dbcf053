"""Conversation structure repair: the cheapest edits that make turns alternate, by a Viterbi search with coalescing survivors.

1. Spark marks each row: blank, seen earlier in its conversation, or cut off. Equal rows of a turn are counted before the
   shuffle, and first occurrences are minima of hashed rows, so copies cost no more than one row.
2. Rows come sorted by conversation and turn. A search over four states (nothing yet, behind a system, user or assistant
   row) keeps one survivor a state: the cheapest path, by complete edit string where costs are tied. A survivor that
   another one beats whatever follows is given up.
3. Survivors are leaves of a tree of back pointers whose nodes count the branches below them. A branch that no survivor ends in is
   released; while the root has one branch only, all survivors share it and its edits are emitted. So memory holds the
   unresolved part of one conversation, however long it is.
4. Ties are decided by all edits since the common ancestor. Paths of a step have the same number of rows and none ends in an
   insertion, so none is the start of another, and a step extends their order: by the order of the paths
   before, then by the new edits. Complete strings are so compared without walking them again.

The result is a stream of edits (``repair``); ``repaired`` and ``digests`` read it.

Edits of a row: keep (0), rerole to user or assistant (1), delete (2), which blank and repeated rows require; before a row
or at the end an empty user or assistant row may be inserted (5). Cut-off rows that stay cost 5 more.

Defined cases: a null role or text counts as one space, null turns come first and a null conversation is one of its own.
Rows of a turn are taken by role and text. A role counts by its first letter, so ``user2`` is a user; an empty or foreign role
never stays as it is. Repeated rows are repetitions. Very long texts are held while unresolved. Other columns are ignored.
An empty table gives an empty result; ``copies`` of 0 names a conversation without a row, which then has no edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import land, small_batches

#: White space, ends of a sentence, costs of the edits.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States by the last row, and what each state asks for.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: What it costs at most to go on from the first state as cheaply as from the second: missing rows are inserted, and a system
#: row that only the second may keep is deleted.
CATCH_UP = {
    (NONE, SYSTEM): 0, (NONE, USER): INSERT, (NONE, ASSISTANT): 0,
    (SYSTEM, NONE): 2 * INSERT, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, NONE): INSERT + DELETE, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, NONE): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FLUSH_ROWS, FLUSH_CHARS = 1000, 1 << 20


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (copies 0), 1 empties its text, 2 takes
    the ends of sentences away, 3 repeats it (copies 2), 4 makes it a user's."""
    told = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    fault = F.col("_fault")
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(told) % 20).alias("_fault")).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 0, "").when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def marked(turns: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with ``copies``, ``blank``, ``again`` (first copy was seen earlier) and ``cut``."""
    copies = F.col("copies").cast("bigint") if "copies" in turns.columns else F.lit(1).cast("bigint")
    text, role = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("text", "role"))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role, text, copies.alias("copies"))
    own = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text"), 256)
    counted = land(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("own", own), "turns")
    # Nulls are the least in a struct, as they come first in order.
    first = counted.filter("copies > 0").groupBy("own").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first")).filter("n > 1")
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    return counted.join(first, "own", "left").select(
        "conv_id", "turn", "role", "text", "copies",
        (left == "").alias("blank"),
        (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("again"),
        (~F.right(left, F.lit(1)).isin(*ENDS)).alias("cut"),
    )


class Node:
    """Edits of one step, below those of the steps before; ``below`` are its branches that a survivor ends in."""

    __slots__ = ("parent", "below", "state", "edits", "times", "turn", "role", "text")

    def __init__(self, parent: Node | None, state: int, edits: str = "", times: int = 1, turn: int | None = None, role: str = "", text: str | None = None) -> None:
        self.parent, self.below, self.state, self.edits, self.times = parent, set(), state, edits, times
        self.turn, self.role, self.text = turn, role, text
        if parent is not None:
            parent.below.add(self)


class Search:
    """Survivors of one conversation: cost and leaf by state, in the order of their edit strings."""

    def __init__(self) -> None:
        self.root = Node(None, NONE)
        self.survivors: dict[int, tuple[int, Node]] = {NONE: (0, self.root)}

    def row(self, turn: int | None, role: str, text: str, cut: bool) -> Iterator[Node]:
        own, more = STATE_OF.get(role[:1]), CUT_OFF if cut else 0

        def options(state: int) -> Iterator[tuple[int, int, str]]:
            yield DELETE, state, "D"
            for cost, before, edits in ((0, state, ""), (INSERT, NEXT[state], "I")):
                if own == NEXT[before] or (own == SYSTEM and before == NONE):
                    yield cost + more, own, edits + "K"
                if own != NEXT[before]:
                    yield cost + more + REROLE, NEXT[before], edits + "R"

        return self._step(options, lambda parent, state, edits: Node(parent, state, edits, 1, turn, role, None if edits == "D" else text))

    def gone(self, turn: int | None, times: int) -> Iterator[Node]:
        """Rows that must be deleted. Insertions come behind them, since D is before I."""
        return self._step(lambda state: [(DELETE * times, state, "D")], lambda parent, state, edits: Node(parent, state, edits, times, turn))

    def end(self) -> tuple[int, Iterator[Node]]:
        """Cost of the cheapest path that ends behind an assistant's row, or without any, and its last edits."""
        missing = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
        cost, _, (_, leaf) = min(
            ((cost + INSERT * len(missing[state]), place, (state, leaf)) for place, (state, (cost, leaf)) in enumerate(self.survivors.items())),
            key=lambda path: path[:2],
        )
        self._keep({leaf.state: (cost, Node(leaf, ASSISTANT if missing[leaf.state] else leaf.state, missing[leaf.state]))})
        return cost, self._settled()

    def _step(self, options, node) -> Iterator[Node]:
        best: dict[int, tuple[int, int, str, Node]] = {}
        for place, (state, (cost, leaf)) in enumerate(self.survivors.items()):
            for more, to, edits in options(state):
                path = (cost + more, place, edits, leaf)
                if to not in best or path[:3] < best[to][:3]:
                    best[to] = path
        # A path that another one beats whatever follows would keep its past alive for nothing.
        hopeless = {x for x in best for y in best if x != y and best[y][0] + CATCH_UP[y, x] < best[x][0]}
        ordered = sorted(((to, path) for to, path in best.items() if to not in hopeless), key=lambda item: item[1][1:3])
        self._keep({to: (cost, node(leaf, to, edits)) for to, (cost, _, edits, leaf) in ordered})
        return self._settled()

    def _keep(self, survivors: dict[int, tuple[int, Node]]) -> None:
        old, self.survivors = self.survivors, survivors
        for _, node in old.values():
            while not node.below and node.parent is not None:
                node.parent.below.discard(node)
                node = node.parent

    def _settled(self) -> Iterator[Node]:
        """Steps that all survivors share, from the root downwards."""
        while len(self.root.below) == 1:
            node = self.root.below.pop()
            yield node
            node.parent, self.root = None, node


EDIT_SCHEMA = (
    "conv_id bigint, edit string, times bigint, turn bigint, role string, text string, "
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
)
_FIELDS = ["conv_id", "edit", "times", "turn", "role", "text", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ARROW = pa.schema([(n, pa.string() if n in ("edit", "role", "text") else pa.int64()) for n in _FIELDS])


def _written(conv_id: int | None, node: Node, before: int) -> Iterator[dict]:
    state = before
    for edit in node.edits:
        if edit == "D":
            yield {"conv_id": conv_id, "edit": "D", "times": node.times, "turn": node.turn}
        elif edit == "I":
            state = NEXT[state]
            yield {"conv_id": conv_id, "edit": "I", "times": 1, "role": ROLE_OF[state], "text": ""}
        else:
            role = node.role if edit == "K" else ROLE_OF[node.state]
            yield {"conv_id": conv_id, "edit": edit, "times": 1, "turn": node.turn, "role": role, "text": node.text}


def _conversation(conv_id: int | None, rows: Iterator[dict]) -> Iterator[dict]:
    search, state, last = Search(), NONE, None
    turns = {"first": None, "last": None, "n": 0}
    found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def written(nodes: Iterator[Node]) -> Iterator[dict]:
        nonlocal state
        for node in nodes:
            yield from _written(conv_id, node, state)
            state = node.state

    for row in rows:
        copies, turn = row["copies"], row["turn"]
        if not copies:
            continue
        if turn is not None and turn != turns["last"]:
            turns = {"first": turn if turns["n"] == 0 else turns["first"], "last": turn, "n": turns["n"] + 1}
        initial = row["role"][:1]
        found["illegal"] += (last is not None and (last, initial) not in LEGAL) + copies - 1
        last = initial
        stays = not row["blank"] and not row["again"]
        found["blank" if row["blank"] else "duplicate"] += copies - stays
        if stays:
            found["truncated"] += row["cut"]
            yield from written(search.row(turn, row["role"], row["text"], row["cut"]))
        if copies > stays:
            yield from written(search.gone(turn, copies - stays))
    cost, nodes = search.end()
    yield from written(nodes)
    gaps = turns["last"] - turns["first"] + 1 - turns["n"] if turns["n"] else 0
    yield {"conv_id": conv_id, "gaps": gaps, "cost": cost, **found}


def repair(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text and, if given, copies) to edits in order, conversation by conversation.

    A row is one edit (K, R, D or I; ``times`` for deletions in a row) with the repaired role and text, or, without an edit, the end of
    a conversation with its faults and cost. Order holds inside a partition, which holds whole conversations.
    """
    small_batches(turns.sparkSession)
    rows = marked(turns).repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for edit in _edits(row for batch in batches for row in _rows(batch)):
            held.append(edit)
            size += len(edit.get("text") or "")
            if len(held) >= FLUSH_ROWS or size >= FLUSH_CHARS:
                yield pa.RecordBatch.from_pylist(held, _ARROW)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _ARROW)

    return rows.mapInArrow(run, EDIT_SCHEMA)


def _rows(batch: pa.RecordBatch, step: int = 100) -> Iterator[dict]:
    for start in range(0, batch.num_rows, step):
        yield from batch.slice(start, step).to_pylist()


def _edits(rows: Iterator[dict]) -> Iterator[dict]:
    row = next(rows, None)
    while row is not None:
        conv_id, ahead = row["conv_id"], [row]

        def own() -> Iterator[dict]:
            while ahead[0] is not None and ahead[0]["conv_id"] == conv_id:
                yield ahead[0]
                ahead[0] = next(rows, None)

        yield from _conversation(conv_id, own())
        row = ahead[0]


def repaired(edits: DataFrame) -> DataFrame:
    """The turns that remain, in the order of ``edits``: conv_id, turn (null for inserted ones), role, text."""
    return edits.filter("edit IN ('K', 'R', 'I')").select("conv_id", "turn", "role", "text")


DIGEST_SCHEMA = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def digests(edits: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, cost, edits as a string, and the digest of what remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, told, joint, out = [], hashlib.sha256(), b"", []
        for batch in batches:
            for edit in _rows(batch):
                if edit["edit"] is None:
                    ends = {k: edit[k] for k in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
                    out.append({**ends, "audit": "".join(audit), "repaired_sha256": told.hexdigest()})
                    audit, told, joint = [], hashlib.sha256(), b""
                    continue
                audit.append(edit["edit"] * edit["times"])
                if edit["edit"] != "D":
                    told.update(joint + f"{edit['role']}:{edit['text']}".encode())
                    joint = b"\n"
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGESTS)
                out = []

    return edits.mapInArrow(run, DIGEST_SCHEMA)


_DIGESTS = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
