"""Chat formatting: templates compiled to Python closures, applied to conversations turn by turn.

The template language is small and closed: text, ``{{ value | filter }}``, ``{% if %}`` /
``{% elif %}`` / ``{% else %}``, ``{% for turn in turns %}`` and ``{% generation %}``, whose output is what
a model is trained on. Values are the names that rendering is given, fields of a turn, strings, numbers,
comparisons, ``and``, ``or``, ``not`` and ``+``; nothing else can be reached from a template.

A template is parsed to a syntax tree, constants are folded, and closures are generated once per
task. The loop over turns is what Spark distributes: what stands before, inside and after it are
rendered apart, so no conversation is ever held whole. Control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---- syntax tree -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Call:
    """An operator or filter applied to values."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Out:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    body: tuple
    otherwise: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    """A template that is not well formed, or asks for something outside the language."""


CONTROL = re.compile(r"\\|</?turn|###")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Control strings and backslashes are preceded by a backslash."""
    return CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_name(text: str) -> str:
    """For a name that ends at ``>``."""
    return re.sub(r"[\\>]", lambda m: "\\" + m.group(), text)


FILTERS: dict[str, Callable] = {"escape": escape, "name": escape_name, "trim": str.strip, "lower": str.lower, "upper": str.upper}
OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: a + b,
    "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
}

# ---- parser ------------------------------------------------------------------------------------

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(-?)(.*?)(-?)%\}", re.DOTALL)
_WORDS = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[|().+]))""")


class _Expression:
    """Recursive descent over the words of one expression."""

    def __init__(self, text: str):
        self.words, at = [], 0
        text = text.strip()
        while at < len(text):
            if not (m := _WORDS.match(text, at)):
                raise TemplateError(f"not understood: {text[at:]!r}")
            self.words.append(m)
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        return self.words[self.at].group().strip() if self.at < len(self.words) else ""

    def take(self, wanted: str | None = None) -> re.Match:
        if self.at >= len(self.words) or wanted and self.peek() != wanted:
            raise TemplateError(f"expected {wanted or 'a value'}")
        self.at += 1
        return self.words[self.at - 1]

    def whole(self):
        value = self.binary(("or",), lambda: self.binary(("and",), self.negated))
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.peek()!r}")
        return value

    def binary(self, names: tuple[str, ...], part: Callable):
        value = part()
        while self.peek() in names:
            name = self.take().group().strip()
            value = Call(name, (value, part()))
        return value

    def negated(self):
        if self.peek() == "not":
            self.take()
            return Call("not", (self.negated(),))
        return self.binary(("==", "!="), lambda: self.binary(("+",), self.filtered))

    def filtered(self):
        value = self.atom()
        while self.peek() == "|":
            self.take()
            name = self.take().group().strip()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Call(name, (value,))
        return value

    def atom(self):
        word = self.take()
        if word[1]:
            body = word[1][1:-1]
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), body, flags=re.DOTALL))
        if word[2]:
            return Const(int(word[2]))
        if word[3]:
            path = [word[3]]
            while self.peek() == ".":
                self.take()
                field = self.take()
                if not field[3] or field[3].startswith("_"):
                    raise TemplateError("a field has a plain name")
                path.append(field[3])
            return Name(tuple(path))
        if word[4] == "(":
            value = self.binary(("or",), lambda: self.binary(("and",), self.negated))
            self.take(")")
            return value
        raise TemplateError(f"unexpected {word.group().strip()!r}")


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    stack: list[tuple[str, object, list, list]] = [("", None, [], [])]  # kind, head, body, finished branches
    at = 0

    def text(piece: str) -> None:
        if piece:
            stack[-1][2].append(Out(Const(piece)))

    def closed(kind: str, head: object, body: list, branches: list):
        if kind == "for":
            return For(head[0], head[1], tuple(body))
        if kind == "generation":
            return Generation(tuple(body))
        branches = [*branches, (head, tuple(body))]
        otherwise: tuple = ()
        for test, part in reversed(branches):
            otherwise = part if test is None else (If(test, part, otherwise),)
        return otherwise[0] if branches[0][0] is not None else None

    for m in _PARTS.finditer(source):
        before = source[at : m.start()]
        text(before.rstrip() if m[2] else before)
        at = m.end()
        if m[4]:
            at += len(source[at:]) - len(source[at:].lstrip())
        if m[1] is not None:
            stack[-1][2].append(Out(_Expression(m[1]).whole()))
            continue
        word, _, rest = m[3].strip().partition(" ")
        if word == "if":
            stack.append(("if", _Expression(rest).whole(), [], []))
        elif word in ("elif", "else") and stack[-1][0] == "if" and stack[-1][1] is not None:
            kind, head, body, branches = stack.pop()
            stack.append((kind, _Expression(rest).whole() if word == "elif" else None, [], [*branches, (head, tuple(body))]))
        elif word == "for" and (loop := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.DOTALL)):
            stack.append(("for", (loop[1], _Expression(loop[2]).whole()), [], []))
        elif word == "generation" and not rest.strip():
            stack.append(("generation", None, [], []))
        elif word in ("endif", "endfor", "endgeneration") and stack[-1][0] == word[3:]:
            node = closed(*stack.pop())
            stack[-1][2].append(node)
        else:
            raise TemplateError(f"misplaced or unknown: {m[3].strip()!r}")
    text(source[at:])
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return tuple(stack[0][2])


# ---- folding -----------------------------------------------------------------------------------


def fold_value(node):
    if isinstance(node, Call):
        args = tuple(map(fold_value, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const((OPERATORS.get(node.name) or FILTERS[node.name])(*(a.value for a in args)))
        return Call(node.name, args)
    return node


def fold(nodes: tuple) -> tuple:
    """Constant expressions are evaluated, decided branches taken, neighbouring texts joined."""
    out: list = []
    for node in nodes:
        if isinstance(node, Out):
            value = fold_value(node.value)
            new = [Out(Const(_shown(value.value)) if isinstance(value, Const) else value)]
        elif isinstance(node, If):
            test = fold_value(node.test)
            if isinstance(test, Const):
                new = list(fold(node.body if test.value else node.otherwise))
            else:
                new = [If(test, fold(node.body), fold(node.otherwise))]
        elif isinstance(node, For):
            new = [For(node.name, fold_value(node.over), fold(node.body))]
        else:
            new = [Generation(fold(node.body))]
        for n in new:
            last = out[-1] if out else None
            if isinstance(n, Out) and isinstance(n.value, Const) and isinstance(last, Out) and isinstance(last.value, Const):
                out[-1] = Out(Const(last.value.value + n.value.value))
            elif n != Out(Const("")):
                out.append(n)
    return tuple(out)


def _shown(value: object) -> str:
    return "" if value is None else str(value)


# ---- closures ----------------------------------------------------------------------------------

Scope = dict
# Rendering appends (text, is generation) pieces.
Render = Callable[[Scope, list, bool], None]


def value_of(node) -> Callable[[Scope], object]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        first, rest = node.path[0], node.path[1:]

        def look(scope: Scope):
            value = scope.get(first)
            for field in rest:
                value = value.get(field) if isinstance(value, dict) else None
            return value

        return look
    args = [value_of(a) for a in node.args]
    if node.name in ("and", "or"):
        a, b = args
        return (lambda s: a(s) and b(s)) if node.name == "and" else (lambda s: a(s) or b(s))
    if node.name in OPERATORS:
        f = OPERATORS[node.name]
        return (lambda s: f(args[0](s))) if len(args) == 1 else (lambda s: f(args[0](s), args[1](s)))
    f = FILTERS[node.name]
    return lambda s: f(_shown(args[0](s)))


def compile_nodes(nodes: tuple) -> Render:
    steps: list[Render] = []
    for node in nodes:
        if isinstance(node, Out):
            if isinstance(node.value, Const):
                steps.append(lambda s, out, g, t=node.value.value: out.append((t, g)))
            else:
                steps.append(lambda s, out, g, v=value_of(node.value): out.append((_shown(v(s)), g)))
        elif isinstance(node, If):
            steps.append(lambda s, out, g, t=value_of(node.test), a=compile_nodes(node.body), b=compile_nodes(node.otherwise): (a if t(s) else b)(s, out, g))
        elif isinstance(node, Generation):
            steps.append(lambda s, out, g, a=compile_nodes(node.body): a(s, out, True))
        else:

            def loop(s, out, g, name=node.name, over=value_of(node.over), body=compile_nodes(node.body)):
                for item in over(s) or ():
                    body(s | {name: item}, out, g)

            steps.append(loop)

    def render(scope: Scope, out: list, generation: bool) -> None:
        for step in steps:
            step(scope, out, generation)

    return render


class Template:
    """A compiled template. Its one loop over ``turns`` may also be rendered a turn at a time."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self.render = compile_nodes(self.tree)
        at = [i for i, n in enumerate(self.tree) if isinstance(n, For) and n.over == Name(("turns",))]
        if len(at) != 1:
            raise TemplateError("the template needs one outer loop over turns")
        self.before, self.after = compile_nodes(self.tree[: at[0]]), compile_nodes(self.tree[at[0] + 1 :])
        self.name, self.body = self.tree[at[0]].name, compile_nodes(self.tree[at[0]].body)

    def pieces(self, **names) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        self.render(names, out, False)
        return [p for p in out if p[0]]

    def turn_pieces(self, turn: dict, first: bool, last: bool, **names) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        if first:
            self.before(names, out, False)
        self.body(names | {self.name: turn}, out, False)
        if last:
            self.after(names, out, False)
        return [p for p in out if p[0]]


#: Marks turns; what assistants say, and nothing else, is trained on.
DEFAULT = (
    "### Conversation\n{% for turn in turns %}<turn {{ turn.role | name }}>\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}"
    "</turn>\n{% endfor %}### End"
)


def format_turns(turns: DataFrame, template: str = DEFAULT) -> DataFrame:
    """conv_id, position, formatted, spans: one row per turn, the stretch of the formatted conversation that it fills.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored, whatever their names. A conversation's
    formatted text is its rows' ``formatted`` by ``position`` (from 0), joined. ``spans`` are the stretches (first, end in code points of
    ``formatted``) to train on. Turns are ordered by turn, nulls first, ties by role and text; null roles and
    texts are empty. Rows with a null conv_id are one conversation. Repeated rows are turns of their own. An empty table gives no rows.
    """
    Template(template)  # errors here, not in a task
    clean = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = clean.select(
        "conv_id", "role", "text", (F.row_number().over(by_turn) - 1).cast("long").alias("position"),
        F.lead(F.lit(False), 1, True).over(by_turn).alias("last"),
    )
    kind = turns.schema["conv_id"].dataType.simpleString()

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        for batch in batches:
            texts, spans = [], []
            for role, text, position, last in zip(*(batch.column(c).to_pylist() for c in ("role", "text", "position", "last")), strict=True):
                pieces = compiled.turn_pieces({"role": role, "text": text}, position == 0, last)
                at, marks = 0, []
                for piece, trained in pieces:
                    if trained:
                        marks.append({"first": at, "end": at + len(piece)})
                    at += len(piece)
                texts.append("".join(p for p, _ in pieces))
                spans.append(marks)
            span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("position"), pa.array(texts, pa.string()), pa.array(spans, span)], ["conv_id", "position", "formatted", "spans"])

    return numbered.mapInArrow(render, f"conv_id {kind}, position long, formatted string, spans array<struct<first long, end long>>")


_TURN = re.compile(r"<turn ((?:[^\\>]++|\\.)*+)>\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a text that ``DEFAULT`` has formatted."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from what ``DEFAULT`` has formatted.

    A conversation is read as a stream of its rows in order, so its length does not matter for memory.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.select("conv_id", "position", "formatted", "spans")
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "position")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state, done, conv_type = None, [], None

        def close():
            conv, turns, said, loss_n, loss, chars = state
            done.append((conv, turns, said.hexdigest(), loss_n, loss.hexdigest(), chars))

        def out():
            columns = list(zip(*done, strict=True))
            kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, position, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "formatted", "spans")), strict=True):
                if position == 0:
                    if state:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescape(text[s["first"] : s["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if len(done) > 10_000:
                yield out()
        if state:
            close()
        if done:
            yield out()

    return ordered.mapInArrow(digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
