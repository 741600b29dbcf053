"""Chat formatting: a sandboxed template language compiled to Python closures.

A template is text with ``{{ expression }}``, ``{% for x in name %}``, ``{% if expression %} ... {% else %}`` and ``{% generation %}``, each
closed by ``{% end... %}``. Expressions have string and integer literals, names, fields (``m.text``), ``==``, ``!=``, ``+``, ``and``, ``or``,
``not``, parentheses and filters (``m.text|guard``). It is parsed into a syntax tree, constant parts are folded, and every node becomes
a closure. Sandbox: names are those passed in, fields are looked up in the message alone, filters are those of FILTERS; there are
no calls, attributes, imports or assignments. What a generation block emits is under the loss mask, given as spans.

The default template marks turns with ``<|im_start|>`` and ``<|im_end|>``. ``guard`` puts a backslash before backslashes and inside
``<|``, so no text can hold a control string, and ``unguard`` takes it off again; ``line`` also guards line ends, for roles.

Turns are shuffled by conversation and sorted within the task; a task holds one conversation at a time, the unit
that becomes one text.

Defined cases: null text or role is empty; a null conversation id is a conversation; turns are ordered by turn (null first), then role and
text; repeated rows are repeated turns; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + m.role|line + '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|guard }}{% endgeneration %}{% else %}{{ m.text|guard }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}{% endfor %}"
)


def guard(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def line(text: str) -> str:
    return guard(text).replace("\n", "\\n")


def unguard(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {"guard": guard, "line": line, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """A template that the language does not allow."""


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+|.()]))")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'"}


class Expression:
    """Recursive descent over the tokens of one expression; trees are tuples whose first item names the node."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:].strip()!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()

    def next(self, *wanted: str) -> str | None:
        if self.tokens and self.tokens[0][1] in wanted and self.tokens[0][0] != "string":
            return self.tokens.pop(0)[1]
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.tokens:
            raise TemplateError(f"left over: {self.tokens[0][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.next("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.next("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.next("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.added()
        while sign := self.next("==", "!="):
            tree = (sign, tree, self.added())
        return tree

    def added(self) -> tuple:
        tree = self.filtered()
        while self.next("+"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.atom()
        while sign := self.next("|", "."):
            if not self.tokens or self.tokens[0][0] != "name":
                raise TemplateError(f"a name must follow {sign!r}")
            name = self.tokens.pop(0)[1]
            if sign == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter" if sign == "|" else "field", tree, name)
        return tree

    def atom(self) -> tuple:
        if not self.tokens:
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens.pop(0)
        if kind == "string":
            return ("constant", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1]))
        if kind == "number":
            return ("constant", int(value))
        if kind == "name":
            return ("name", value)
        if value == "(":
            tree = self.either()
            if not self.next(")"):
                raise TemplateError("a parenthesis is open")
            return tree
        raise TemplateError(f"misplaced {value!r}")


def fold(tree: tuple) -> tuple:
    """Constant operands become constants; ``+`` joins neighbouring constants."""
    parts = tuple(fold(x) if isinstance(x, tuple) else x for x in tree)
    kids = [x for x in parts[1:] if isinstance(x, tuple)]
    if kids and all(k[0] == "constant" for k in kids) and parts[0] != "field":
        return ("constant", value_of(parts)({}))
    if parts[0] == "+" and parts[2][0] == "constant" and parts[1][0] == "+" and parts[1][2][0] == "constant":
        return ("+", parts[1][1], ("constant", parts[1][2][1] + parts[2][1]))
    return parts


def value_of(tree: tuple) -> Callable[[dict], object]:
    """The closure of an expression."""
    kind, *rest = tree
    if kind == "constant":
        return lambda env, x=rest[0]: x
    if kind == "name":
        return lambda env, x=rest[0]: env[x]
    if kind == "field":
        owner = value_of(rest[0])
        return lambda env, x=rest[1]: owner(env)[x]
    if kind == "filter":
        inner, f = value_of(rest[0]), FILTERS[rest[1]]
        return lambda env: f(inner(env))
    if kind == "not":
        inner = value_of(rest[0])
        return lambda env: not inner(env)
    a, b = value_of(rest[0]), value_of(rest[1])
    return {
        "or": lambda env: a(env) or b(env),
        "and": lambda env: a(env) and b(env),
        "==": lambda env: a(env) == b(env),
        "!=": lambda env: a(env) != b(env),
        "+": lambda env: a(env) + b(env),
    }[kind]


def parse(template: str) -> list[tuple]:
    """The tree of a template: text, output, for, if and generation nodes."""
    parts, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            parts.append(("text", template[at : m.start()]))
        parts.append(("output", fold(Expression(m[1]).whole())) if m[1] is not None else ("tag", m[2].split(None, 1)))
        at = m.end()
    if at < len(template):
        parts.append(("text", template[at:]))
    body, end = _body(parts, ())
    return body


def _body(parts: list, closers: tuple[str, ...]) -> tuple[list[tuple], str]:
    body = []
    while parts:
        kind, what = parts.pop(0)
        if kind == "output" and what[0] == "constant":
            kind, what = "text", str(what[1])
        if kind == "text" and body and body[-1][0] == "text":
            body[-1] = ("text", body[-1][1] + what)
        elif kind != "tag":
            body.append((kind, what))
        elif not what:
            raise TemplateError("an empty tag")
        elif what[0] in closers:
            return body, what[0]
        elif what[0] == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+([A-Za-z_]\w*)\s*", what[1] if len(what) > 1 else "")
            if not m:
                raise TemplateError("for needs a name in a name")
            body.append(("for", m[1], m[2], _body(parts, ("endfor",))[0]))
        elif what[0] == "if":
            test = fold(Expression(what[1] if len(what) > 1 else "").whole())
            yes, end = _body(parts, ("else", "endif"))
            no = _body(parts, ("endif",))[0] if end == "else" else []
            if test[0] == "constant":
                body.extend(yes if test[1] else no)
            else:
                body.append(("if", test, yes, no))
        elif what[0] == "generation":
            body.append(("generation", _body(parts, ("endgeneration",))[0]))
        else:
            raise TemplateError(f"no tag {what[0]!r} here")
    if closers:
        raise TemplateError(f"{closers[-1]} is missing")
    return body, ""


Emit = Callable[[str], None]


def compiled(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from names to the text and the spans, in code points, that generation blocks emitted."""
    run = _block(parse(template))

    def render(env: dict) -> tuple[str, list[tuple[int, int]]]:
        out, spans = [], []
        run(dict(env), out, spans, [0])
        return "".join(out), spans

    return render


def _block(body: list[tuple]) -> Callable:
    steps = [_step(x) for x in body]

    def run(env: dict, out: list, spans: list, at: list) -> None:
        for step in steps:
            step(env, out, spans, at)

    return run


def _step(node: tuple) -> Callable:
    kind = node[0]
    if kind in ("text", "output"):
        value = value_of(("constant", node[1]) if kind == "text" else node[1])

        def emit(env, out, spans, at):
            text = str(value(env))
            out.append(text)
            at[0] += len(text)

        return emit
    if kind == "for":
        name, source, inner = node[1], node[2], _block(node[3])

        def loop(env, out, spans, at):
            for item in env[source]:
                inner({**env, name: item}, out, spans, at)

        return loop
    if kind == "if":
        test, yes, no = value_of(node[1]), _block(node[2]), _block(node[3])
        return lambda env, out, spans, at: (yes if test(env) else no)(env, out, spans, at)
    inner = _block(node[1])

    def generation(env, out, spans, at):
        start = at[0]
        inner(env, out, spans, at)
        spans.append((start, at[0]))

    return generation


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a conversation in the default marks."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        head = formatted.index("\n", at)
        close = formatted.index(END, head)
        turns.append((unguard(formatted[at + len(START) : head]), unguard(formatted[head + 1 : close])))
        at = close + len(END) + 1
    return turns


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) to conv_id, formatted and loss_spans (start, stop in code points)."""
    compiled(template)  # a faulty template fails here
    rows = (
        turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        messages = (row for batch in batches for row in batch.to_pylist())
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            ids, texts, spans = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], span)],
                names=["conv_id", "formatted", "loss_spans"],
            )

        for conv_id, own in groupby(messages, key=lambda m: m["conv_id"]):
            text, spans = render({"messages": list(own)})
            held.append((conv_id, text, spans))
            size += len(text)
            if size > 1 << 20:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return rows.mapInArrow(run, "conv_id bigint, formatted string, loss_spans array<struct<start:bigint,stop:bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds: turns and text under the loss mask, as counts and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = turns_of(row["formatted"])
                loss = "".join(unguard(row["formatted"][s["start"] : s["stop"]]) for s in row["loss_spans"])
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((row["conv_id"], len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(row["formatted"])))
            columns = zip(*out) if out else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=DIGESTS)

    kinds = ("bigint", "bigint", "string", "bigint", "string", "bigint")
    return formatted.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(DIGESTS, kinds)))


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
