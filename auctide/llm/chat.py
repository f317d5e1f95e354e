r"""Chat formatting with a small template compiler.

A template of a sandboxed language is parsed into a syntax tree, constants are
folded, and Python closures are generated that render a conversation and mark
the text under ``{% generation %}``. The language has text, ``{{ expression }}``,
``{% for x in messages %}``, ``{% if %}``/``{% elif %}``/``{% else %}`` and
``{% generation %}``; expressions know strings, names, ``x.field`` of a loop
variable, ``loop.first``, ``+``, ``==``, ``!=``, ``and``, ``or``, ``not`` and
the filter ``| escape``. There are no calls, no attributes of Python objects,
no imports and no unbounded loops, so a template cannot reach the host.

Closures write to a sink and read messages from an iterator, so a conversation
is rendered turn by turn and never held as a whole. Rows are dealt by conv_id
and sorted by turn inside a partition by Spark.

Control strings inside texts and roles are escaped reversibly: a ``<`` that
backslashes (or none) and a ``|`` follow gets one backslash more; in roles,
backslash and line feed are then written as backslash escapes. The reader
takes the formatted output apart again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHATML = ("{% for m in messages %}<|im_start|>{{ m.role | escape_role }}\n"
          "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
          "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}")


class TemplateError(ValueError):
    pass


def escape(s: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", s) if "<" in s else s


def unescape(s: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", s) if "<" in s else s


_ROLE_OUT = {"\\": "\\\\", "\n": "\\n"}


def escape_role(s: str) -> str:
    return re.sub(r"[\\\n]", lambda m: _ROLE_OUT[m[0]], escape(s))


def unescape_role(s: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s, flags=re.S))


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_role": escape_role}


# -- syntax tree: tuples (kind, ...) ------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?\s*(.*?)\s*-?%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(==|!=|[+|().])|([A-Za-z_]\w*))")


class _Parser:
    """Recursive descent over tags; expression grammar: or < and < not < equality < + < filter."""

    def __init__(self, template: str):
        self.parts: list[tuple[str, str]] = []
        at = 0
        for m in _TAG.finditer(template):
            if m.start() > at:
                self.parts.append(("text", template[at:m.start()]))
            self.parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2]))
            at = m.end()
        if at < len(template):
            self.parts.append(("text", template[at:]))
        self.i = 0

    def block(self, until: tuple[str, ...]) -> tuple[list, str]:
        body: list = []
        while self.i < len(self.parts):
            kind, s = self.parts[self.i]
            self.i += 1
            if kind == "text":
                body.append(("text", s))
            elif kind == "out":
                body.append(("out", expression(s)))
            else:
                word = s.split(None, 1)[0] if s else ""
                if word in until:
                    return body, s
                body.append(self.tag(word, s))
        if until:
            raise TemplateError(f"missing {' or '.join(until)}")
        return body, ""

    def tag(self, word: str, s: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", s)
            if not m:
                raise TemplateError(f"only 'for <name> in messages' is known: {s}")
            body, _ = self.block(("endfor",))
            return ("for", m[1], body)
        if word == "generation":
            body, _ = self.block(("endgeneration",))
            return ("generation", body)
        if word == "if":
            arms, cond = [], expression(s[2:])
            while True:
                body, end = self.block(("elif", "else", "endif"))
                arms.append((cond, body))
                if end.startswith("elif"):
                    cond = expression(end[4:])
                elif end == "else":
                    last, _ = self.block(("endif",))
                    return ("if", arms, last)
                else:
                    return ("if", arms, [])
        raise TemplateError(f"unknown tag: {s}")


def expression(source: str) -> tuple:
    tokens, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read expression: {source}")
        tokens.append(("str", re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t"}.get(x[1], x[1]), m[1][1:-1]))
                      if m[1] else ("op", m[2]) if m[2] else ("name", m[3]))
        at = m.end()
    pos = 0

    def peek(*values) -> bool:
        return pos < len(tokens) and tokens[pos][0] != "str" and tokens[pos][1] in values

    def take() -> tuple:
        nonlocal pos
        if pos >= len(tokens):
            raise TemplateError(f"expression ends early: {source}")
        pos += 1
        return tokens[pos - 1]

    def binary(below, *ops):
        left = below()
        while peek(*ops):
            op = take()[1]
            left = (op, left, below())
        return left

    def primary() -> tuple:
        kind, v = take()
        if kind == "str":
            node: tuple = ("const", v)
        elif (kind, v) == ("op", "("):
            node = alternatives()
            if take() != ("op", ")"):
                raise TemplateError(f"missing ) in {source}")
        elif kind == "name":
            node = ("const", v == "true") if v in ("true", "false") else ("name", v)
            if peek("."):
                take()
                field, name = take()
                if field != "name":
                    raise TemplateError(f"a field name must follow the dot: {source}")
                node = ("field", v, name)
        else:
            raise TemplateError(f"unexpected {v!r} in {source}")
        while peek("|"):
            take()
            name = take()[1]
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name}")
            node = ("filter", name, node)
        return node

    def negation() -> tuple:
        if peek("not"):
            take()
            return ("not", negation())
        return binary(lambda: binary(primary, "+"), "==", "!=")

    def alternatives() -> tuple:
        return binary(lambda: binary(negation, "and"), "or")

    tree = alternatives()
    if pos < len(tokens):
        raise TemplateError(f"cannot read the rest of {source}")
    return tree


def fold(node: tuple) -> tuple:
    """Expression with constant parts evaluated."""
    kind = node[0]
    if kind in ("const", "name", "field"):
        return node
    args = [fold(x) if isinstance(x, tuple) else x for x in node[1:]]
    if all(not isinstance(x, tuple) or x[0] == "const" for x in args):
        return ("const", _closure((kind, *args))({}))
    return (kind, *args)


def fold_block(body: list) -> list:
    """Statements with folded expressions, decided branches taken and neighbouring text joined."""
    out: list = []

    def add(x):
        if x[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + x[1])
        elif x != ("text", ""):
            out.append(x)

    for node in body:
        if node[0] == "out":
            e = fold(node[1])
            add(("text", _show(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "if":
            arms, rest = [], node[2]
            for cond, block in node[1]:
                cond = fold(cond)
                if cond[0] == "const" and cond[1]:
                    rest = block
                    break
                if cond[0] != "const":
                    arms.append((cond, fold_block(block)))
            if arms:
                add(("if", arms, fold_block(rest)))
            else:
                for x in fold_block(rest):
                    add(x)
        elif node[0] == "for":
            add(("for", node[1], fold_block(node[2])))
        elif node[0] == "generation":
            add(("generation", fold_block(node[1])))
        else:
            add(node)
    return out


# -- closures -----------------------------------------------------------------

def _show(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v).lower()


def _closure(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "field":
        name, field = node[1], node[2]

        def get(env):
            v = env.get(name)
            return v.get(field) if isinstance(v, dict) else None
        return get
    if kind == "filter":
        f, inner = FILTERS[node[1]], _closure(node[2])
        return lambda env: f(_show(inner(env)))
    if kind == "not":
        inner = _closure(node[1])
        return lambda env: not inner(env)
    a, b = _closure(node[1]), _closure(node[2])
    return {"+": lambda env: _show(a(env)) + _show(b(env)), "==": lambda env: a(env) == b(env),
            "!=": lambda env: a(env) != b(env), "and": lambda env: a(env) and b(env),
            "or": lambda env: a(env) or b(env)}[kind]


def _block(body: list) -> Callable:
    steps = [_statement(x) for x in body]

    def run(env, sink, masked):
        for s in steps:
            s(env, sink, masked)
    return run


def _statement(node: tuple) -> Callable:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, sink, masked: sink(text, masked)
    if kind == "out":
        value = _closure(node[1])
        return lambda env, sink, masked: sink(_show(value(env)), masked)
    if kind == "generation":
        inner = _block(node[1])
        return lambda env, sink, masked: inner(env, sink, True)
    if kind == "if":
        arms = [(_closure(c), _block(b)) for c, b in node[1]]
        rest = _block(node[2])

        def choose(env, sink, masked):
            for cond, block in arms:
                if cond(env):
                    return block(env, sink, masked)
            return rest(env, sink, masked)
        return choose
    name, inner = node[1], _block(node[2])

    def loop(env, sink, masked):
        for i, message in enumerate(env["messages"]):
            inner({**env, name: message, "loop": {"first": i == 0}}, sink, masked)
    return loop


def compile_template(template: str) -> Callable:
    """``render(messages, sink)``: calls ``sink(text, under the loss mask)`` piece by piece."""
    body, _ = _Parser(template).block(())
    run = _block(fold_block(body))
    return lambda messages, sink: run({"messages": messages}, sink, False)


def render(template: str, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """A whole conversation's text and its spans (code points, end exclusive) under the loss mask."""
    out, spans, at = [], [], 0

    def sink(s, masked):
        nonlocal at
        if masked and s:
            spans.append((at, at + len(s)))
        out.append(s)
        at += len(s)
    compile_template(template)(iter(messages), sink)
    return "".join(out), spans


# -- formatting and reading back ------------------------------------------------

class Reader:
    """Takes formatted output apart piece by piece and keeps the digests of one conversation."""

    START, END = "<|im_start|>", "<|im_end|>\n"

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.pending: list[str] = []
        self.loss_part: list[str] = []

    def __call__(self, piece: str, masked: bool) -> None:
        self.formatted_chars += len(piece)
        self.pending.append(piece)
        if masked:
            self.loss_part.append(piece)
        if piece.endswith(self.END):
            self._turn("".join(self.pending))
            self.pending = []

    def _turn(self, s: str) -> None:
        *whole, rest = s.split(self.END)
        if rest:
            raise ValueError("output does not end with a turn")
        for t in whole:
            if not t.startswith(self.START):
                raise ValueError("a turn must begin with its mark")
            role, _, text = t[len(self.START):].partition("\n")
            self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "replace"))
            self.n_turns += 1
        text = unescape("".join(self.loss_part))
        self.loss_part = []
        self.loss_chars += len(text)
        self.loss.update(text.encode("utf-8", "replace"))

    def row(self) -> tuple:
        if self.pending:
            raise ValueError("output ends inside a turn")
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")
FORMATTED = "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>"


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(conv_id, message) in the order of the rows."""
    for f in frames:
        for c, role, text in zip(f["id"], f["role"], f["text"]):
            yield (None if c is None else int(c)), {"role": role or "", "text": text or ""}


def _conversations(frames) -> Iterator[tuple]:
    from itertools import groupby
    for c, rows in groupby(_groups(frames), key=lambda x: x[0]):
        yield c, (m for _, m in rows)


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows dealt by conversation, in turn order; ties by role and text, nulls first."""
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select(F.col("conv_id").cast("string").alias("id"), "role", "text"))


def format_digests(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """Formats every conversation, reads the output back and returns its digests.

    One row per conv_id (null ids together are one conversation). Null roles
    and texts are empty; rows without a turn come first; repeated rows are
    turns of their own; other columns are ignored; an empty table gives no
    rows. A conversation streams through one task turn by turn (its digests
    are sequential); no task holds a whole conversation.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = compile_template(template)
        rows: list = []
        for c, messages in _conversations(frames):
            reader = Reader()
            write(messages, reader)
            rows.append((c, *reader.row()))
            if len(rows) >= 5000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)

    def _frame(rows):
        f = pd.DataFrame(rows, columns=[x.split()[0] for x in DIGEST.split(", ")])
        return f.astype({"conv_id": "Int64"})

    return _in_order(conversations).mapInPandas(run, DIGEST)


def format_conversations(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """``conv_id, formatted, loss_spans``: the texts themselves, with the spans under the loss mask."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for c, messages in _conversations(frames):
            text, spans = render(template, messages)
            yield pd.DataFrame({"conv_id": pd.array([c], "Int64"), "formatted": [text],
                                "loss_spans": [[{"start": a, "end": b} for a, b in spans]]})

    return _in_order(conversations).mapInPandas(run, FORMATTED)
