"""Chat formatting with a sandboxed template language.

``compile_template`` parses a template into a syntax tree, folds constant expressions and joins constant text, and
generates Python closures. Rendering yields pieces (text, is_generated) one after another, so that a conversation is
never held whole by the renderer. The language has ``{{ expr }}``, ``{% if %}/{% elif %}/{% else %}/{% endif %}``,
``{% for x in expr %}/{% endfor %}`` and ``{% generation %}/{% endgeneration %}``; expressions have literals, names,
``.field`` and ``['field']`` of mappings, ``loop.first`` and ``loop.index0``, ``==  !=  and  or  not  +  ~`` and
filters. There are no calls, no attributes of objects, no assignment and no import: nothing else can be reached.

Control strings inside texts are escaped reversibly: ``\\`` becomes ``\\\\`` and each control string gets a ``\\``
after its first character, so that no control string of an output stems from a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<|", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}{{ '<|turn|>' ~ m.role|escape }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}"
    "{{ '<|' ~ 'end|>' }}\n{% endfor %}"
)
_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))


class TemplateError(ValueError):
    """A template that the language doesn't have, or a value that it can't use."""


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.?)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}

# Syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    arg: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Filter:
    name: str
    arg: Any


@dataclass(frozen=True)
class Output:
    expr: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+~|.()\[\]]))", re.S)


class Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))
        self.at = 0

    def peek(self, *ops: str) -> str | None:
        return self.tokens[self.at][1] if self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in ops else None

    def take(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def want(self, text: str) -> None:
        if self.take()[1] != text:
            raise TemplateError(f"{text!r} is missing")

    def whole(self):
        out = self.either()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def level(self, below: Callable, *ops: str):
        out = below()
        while op := self.peek(*ops):
            self.take()
            out = Binary(op, out, below())
        return out

    def either(self):
        return self.level(self.both, "or")

    def both(self):
        return self.level(self.negated, "and")

    def negated(self):
        if self.peek("not"):
            self.take()
            return Unary(self.negated())
        return self.level(lambda: self.level(lambda: self.level(self.filtered, "+"), "~"), "==", "!=")

    def filtered(self):
        out = self.primary()
        while True:
            if self.peek("|"):
                self.take()
                kind, name = self.take()
                if kind != "name" or name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = Filter(name, out)
            elif self.peek("."):
                self.take()
                kind, name = self.take()
                if kind != "name" or name.startswith("_"):
                    raise TemplateError(f"no field {name!r}")
                out = Field(out, Const(name))
            elif self.peek("["):
                self.take()
                out = Field(out, self.either())
                self.want("]")
            else:
                return out

    def primary(self):
        kind, text = self.take()
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if text == "(":
            out = self.either()
            self.want(")")
            return out
        if kind == "name" and text in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[text])
        if kind == "name" and text not in ("and", "or", "not", "in") and not text.startswith("_"):
            return Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        out: list = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                out.append(Output(Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                tag, _, rest = part[2:-2].strip().partition(" ")
                if tag in ends:
                    return tuple(out), f"{tag} {rest}".strip()
                out.append(statement(tag, rest))
            elif part:
                out.append(Output(Const(part)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), ""

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            return If(Expression(test).whole(), then, (branch(end[5:]),))
        return If(Expression(test).whole(), then, block("endif")[0] if end == "else" else ())

    def statement(tag: str, rest: str):
        if tag == "if":
            return branch(rest)
        if tag == "for" and (m := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)):
            return For(m[1], Expression(m[2]).whole(), block("endfor")[0])
        if tag == "generation" and not rest:
            return Generation(block("endgeneration")[0])
        raise TemplateError(f"no statement {tag!r}")

    return block()[0]


def as_text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} isn't text")


def apply(op: str, left: Any, right: Any) -> Any:
    if op == "~":
        return as_text(left) + as_text(right)
    if op == "+":
        if type(left) is not type(right) or not isinstance(left, (str, int)):
            raise TemplateError("+ takes two texts or two numbers")
        return left + right
    return {"==": left == right, "!=": left != right, "and": left and right, "or": left or right}[op]


def fold(node: Any) -> Any:
    """The node with constant parts computed, dead branches gone and neighbouring constant texts joined."""
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(apply(node.op, left.value, right.value))
        if node.op == "~" and isinstance(right, Const) and isinstance(left, Binary) and left.op == "~" and isinstance(left.right, Const):
            return Binary("~", left.left, Const(as_text(left.right.value) + as_text(right.value)))
        return Binary(node.op, left, right)
    if isinstance(node, Unary):
        arg = fold(node.arg)
        return Const(not arg.value) if isinstance(arg, Const) else Unary(arg)
    if isinstance(node, Filter):
        arg = fold(node.arg)
        return Const(FILTERS[node.name](as_text(arg.value))) if isinstance(arg, Const) else Filter(node.name, arg)
    if isinstance(node, Field):
        return Field(fold(node.of), fold(node.key))
    if isinstance(node, Output):
        return Output(fold(node.expr))
    if isinstance(node, If):
        test = fold(node.test)
        return fold(node.then if test.value else node.other) if isinstance(test, Const) else If(test, fold(node.then), fold(node.other))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, tuple):
        out: list = []
        for x in map(fold, node):
            for y in x if isinstance(x, tuple) else (x,):
                if out and isinstance(y, Output) and isinstance(y.expr, Const) and isinstance(out[-1], Output) and isinstance(out[-1].expr, Const):
                    out[-1] = Output(Const(as_text(out[-1].expr.value) + as_text(y.expr.value)))
                else:
                    out.append(y)
        return tuple(out)
    return node


def value_of(node: Any) -> Callable[[dict], Any]:
    """A closure that computes an expression in a scope."""
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):

        def name(scope: dict, n: str = node.name) -> Any:
            if n not in scope:
                raise TemplateError(f"no name {n!r}")
            return scope[n]

        return name
    if isinstance(node, Field):
        of, key = value_of(node.of), value_of(node.key)

        def field(scope: dict) -> Any:
            holder = of(scope)
            if not isinstance(holder, dict):
                raise TemplateError(f"a {type(holder).__name__} has no fields")
            return holder.get(key(scope))

        return field
    if isinstance(node, Unary):
        arg = value_of(node.arg)
        return lambda scope: not arg(scope)
    if isinstance(node, Filter):
        arg, fn = value_of(node.arg), FILTERS[node.name]
        return lambda scope: fn(as_text(arg(scope)))
    left, right = value_of(node.left), value_of(node.right)
    if node.op == "and":
        return lambda scope: left(scope) and right(scope)
    if node.op == "or":
        return lambda scope: left(scope) or right(scope)
    return lambda scope, op=node.op: apply(op, left(scope), right(scope))


Pieces = Iterator[tuple[str, bool]]


def pieces_of(node: Any, generated: bool = False) -> Callable[[dict], Pieces]:
    """A closure that renders a node in a scope as (text, is_generated)."""
    if isinstance(node, tuple):
        parts = [pieces_of(x, generated) for x in node]

        def every(scope: dict) -> Pieces:
            for part in parts:
                yield from part(scope)

        return every
    if isinstance(node, Output):
        expr = value_of(node.expr)
        return lambda scope: iter(((as_text(expr(scope)), generated),))
    if isinstance(node, Generation):
        return pieces_of(node.body, True)
    if isinstance(node, If):
        test, then, other = value_of(node.test), pieces_of(node.then, generated), pieces_of(node.other, generated)
        return lambda scope: then(scope) if test(scope) else other(scope)
    over, body = value_of(node.over), pieces_of(node.body, generated)

    def loop(scope: dict, name: str = node.name) -> Pieces:
        for i, item in enumerate(over(scope)):
            yield from body(scope | {name: item, "loop": {"first": i == 0, "index0": i}})

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Pieces]:
    """A function from messages (mappings, also lazily given) to the rendered pieces (text, is_generated)."""
    render = pieces_of(fold(parse(source)))
    return lambda messages: render({"messages": messages})


# Spark

KEY = "conv_id"


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn; ties by role and text, nulls first."""
    rows = conversations.select(F.col(KEY).cast("long").alias(KEY), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition(KEY).sortWithinPartitions(KEY, "turn", "role", "text")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, chunk_chars: int = 1 << 20) -> DataFrame:
    """Formatted conversations: rows (conv_id, chunk, formatted, spans), a conversation's chunks in order.

    ``spans`` are the (start, end) code points of ``formatted`` under the loss mask. A conversation is one chunk
    unless its output is longer than ``chunk_chars``; it is rendered row by row, so its length is bounded by no
    task's memory. Null roles and texts are empty; rows with a null conv_id are one conversation with a null id;
    repeated rows are turns of their own; other columns are ignored; an empty table gives an empty table.
    """
    compile_template(template)  # fails here, on the driver, if it can't be compiled
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        rows = rows_of(batches, KEY, "role", "text")
        row = next(rows, None)
        out: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            out.clear()
            kinds = (pa.int64(), pa.int32(), pa.string(), span)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[KEY, "chunk", "formatted", "spans"])

        while row is not None:
            conv = row[0]

            def messages(conv=conv) -> Iterator[dict]:
                nonlocal row
                while row is not None and row[0] == conv:
                    yield {"role": row[1] or "", "text": row[2] or ""}
                    row = next(rows, None)

            chunk, texts, spans, at = 0, [], [], 0
            for text, generated in render(messages()):
                for i in range(0, len(text), chunk_chars):
                    part = text[i : i + chunk_chars]
                    if texts and at + len(part) > chunk_chars:
                        out.append((conv, chunk, "".join(texts), spans))
                        chunk, texts, spans, size, at = chunk + 1, [], [], size + at, 0
                        if size > 8 * chunk_chars:
                            yield flush()
                            size = 0
                    texts.append(part)
                    if generated:
                        spans.append({"start": at, "end": at + len(part)})
                    at += len(part)
            for _ in messages():  # a template that doesn't use them all
                pass
            out.append((conv, chunk, "".join(texts), spans))
            size += at
            if size > 8 * chunk_chars:
                yield flush()
                size = 0
        yield flush()

    return ordered(conversations).mapInArrow(run, f"{KEY} long, chunk int, formatted string, spans array<struct<start:long,end:long>>")


_TURN = re.compile(r"<\|turn\|>(.*?)\n(.*?)<\|end\|>\n", re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_conversations`` made with TEMPLATE, read from its output alone.

    Rows (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars); takes the rows as
    ``format_conversations`` gives them, a conversation's chunks one after another in one partition. A null conv_id is a
    conversation; empty texts are read back as such; text that isn't whole turns is an error; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state: dict | None = None

        def close() -> None:
            if state["rest"] or state["pending"]:
                raise ValueError(f"conversation {state['conv']} ends inside a turn")
            out.append((state["conv"], state["turns"], state["hash"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"]))

        for conv, chunk, text, spans in rows_of(batches, KEY, "chunk", "formatted", "spans"):
            if chunk == 0:
                if state is not None:
                    close()
                state = {"conv": conv, "turns": 0, "hash": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0, "rest": "", "pending": ""}
            state["size"] += len(text)
            body, end = state["rest"] + text, 0
            for m in _TURN.finditer(body):
                state["turns"] += 1
                state["hash"].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                end = m.end()
            state["rest"] = body[end:]
            for s in spans:
                piece = state["pending"] + text[s["start"] : s["end"]]
                # an escape may be cut between chunks
                odd = (len(piece) - len(piece.rstrip("\\"))) % 2
                state["pending"], piece = piece[len(piece) - odd :], unescape(piece[: len(piece) - odd])
                state["chars"] += len(piece)
                state["loss"].update(piece.encode())
            if len(out) >= 1000:
                yield batch_of(out)
                out.clear()
        if state is not None:
            close()
        yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[KEY, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, f"{KEY} long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
