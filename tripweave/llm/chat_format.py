"""Chat formatting (operator 6): a compiler for a small sandboxed template language.

    {{ expression }}   {% for x in expression %} ... {% endfor %}
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}

Expressions have names, ``x.field``, ``x['field']``, strings, integers, True,
False, None, ``==  !=  and  or  not  in  +  ~``, parentheses and filters
(``x | escape``); ``loop.first``, ``loop.last`` and ``loop.index0`` in loops.
There are no calls and no Python attributes, so a template reaches only the
values it is given.  The source is parsed into a syntax tree, constant parts are
folded (also whole branches, and neighbouring texts), and each node becomes a
Python closure.  Rendering yields texts with a flag that tells whether they lie
between generation markers: the loss mask.

Control strings inside texts are escaped reversibly: a backslash is doubled, and
a control string gets a backslash after its first character, so the formatted
conversation holds a control string only where the template put it.

Rows: turns are ordered by (turn, role, text), nulls first; a null text or role
is empty; a null conv_id is a conversation of its own; repeated rows are turns
each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import prepare, record_batch

#: The strings that mark turns, in this and in other templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' + (m.role | escape_line) + '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' }}{{ '\n' }}"
    "{% endfor %}")


# ------------------------------------------------------------------- escaping
_MARK = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + r").", re.S)
_UNMARK = re.compile(r"\\(.?)", re.S)


def escape(text: str) -> str:
    """No control string is left; ``unescape`` gives the text back."""
    return _MARK.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    # doubled backslashes become one; a lone one stood after the first character
    return _UNMARK.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


def escape_line(text: str) -> str:
    """As ``escape``, and on one line."""
    return escape(text).replace("\n", "\\n")


def unescape_line(text: str) -> str:
    return _UNMARK.sub(lambda m: {"n": "\n"}.get(m[1], m[1]), text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda v: escape(_text(v)), "escape_line": lambda v: escape_line(_text(v)),
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v),
}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# -------------------------------------------------------------------- parsing
class TemplateError(ValueError):
    """The template is not in the language."""


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_SYMBOL = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                     r"""|(?P<op>==|!=|[.|()\[\]+~]))""", re.S)
_STRING = {"n": "\n", "t": "\t", "r": "\r"}


def _symbols(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _SYMBOL.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over ``or < and < not < == != in < + ~ < filters < fields``."""

    def __init__(self, source: str):
        self.rest = _symbols(source)[::-1]

    def whole(self) -> tuple:
        node = self.either()
        if self.rest:
            raise TemplateError(f"unexpected {self.rest[-1][1]!r}")
        return node

    def take(self, *words: str) -> str | None:
        if self.rest and self.rest[-1][1] in words and self.rest[-1][0] != "str":
            return self.rest.pop()[1]
        return None

    def need(self, word: str) -> None:
        if not self.take(word):
            raise TemplateError(f"{word!r} expected")

    def chain(self, below: Callable[[], tuple], *words: str) -> tuple:
        node = below()
        while op := self.take(*words):
            node = (op, node, below())
        return node

    def either(self) -> tuple:
        return self.chain(self.both, "or")

    def both(self) -> tuple:
        return self.chain(self.negated, "and")

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.chain(self.sum, "==", "!=", "in")

    def sum(self) -> tuple:
        return self.chain(self.filtered, "+", "~")

    def filtered(self) -> tuple:
        node = self.value()
        while self.take("|"):
            kind, name = self.rest.pop() if self.rest else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            node = ("filter", name, node)
        return node

    def value(self) -> tuple:
        if not self.rest:
            raise TemplateError("expression expected")
        if self.take("("):
            node = self.either()
            self.need(")")
        else:
            kind, word = self.rest.pop()
            if kind == "str":
                node = ("const", re.sub(r"\\(.)", lambda m: _STRING.get(m[1], m[1]), word[1:-1], flags=re.S))
            elif kind == "int":
                node = ("const", int(word))
            elif kind == "name":
                fixed = {"True": True, "true": True, "False": False, "false": False, "None": None, "none": None}
                node = ("const", fixed[word]) if word in fixed else ("name", word)
            else:
                raise TemplateError(f"unexpected {word!r}")
        while op := self.take(".", "["):
            if op == ".":
                kind, word = self.rest.pop() if self.rest else ("", "")
                if kind != "name" or word.startswith("_"):
                    raise TemplateError("field name expected")
                node = ("field", node, ("const", word))
            else:
                node = ("field", node, self.either())
                self.need("]")
        return node


def parse(source: str) -> tuple:
    """Syntax tree of a template: nested tuples, the kind first."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _PIECE.finditer(source):
        pieces.append(("text", source[at:m.start()]))
        if m[1] is not None:
            pieces.append(("print", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    pieces.reverse()

    def body(*ends: str) -> tuple[tuple, str]:
        nodes: list[tuple] = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                nodes.append(("print", ("const", value)))
            elif kind == "print":
                nodes.append(("print", _Expression(value).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("all", *nodes), value
                nodes.append(tag(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return ("all", *nodes), ""

    def tag(word: str, rest: str) -> tuple:
        if word == "generation":
            return ("generation", body("endgeneration")[0])
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return ("for", m[1], _Expression(m[2]).whole(), body("endfor")[0])
        if word == "if":
            test = _Expression(rest).whole()
            then, end = body("elif", "else", "endif")
            word, _, rest = end.partition(" ")
            other = tag("if", rest) if word == "elif" else body("endif")[0] if word == "else" else ("all",)
            return ("if", test, then, other)
        raise TemplateError(f"unknown tag {word!r}")

    return body()[0]


# -------------------------------------------------------------------- folding
_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b,
    "+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b)}


def fold(node: tuple) -> tuple:
    """The same tree with constant parts computed."""
    kind, *parts = node
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        inner = fold(parts[1])
        return ("const", FILTERS[parts[0]](inner[1])) if inner[0] == "const" else ("filter", parts[0], inner)
    if kind == "for":
        return ("for", parts[0], fold(parts[1]), fold(parts[2]))
    done = [fold(p) for p in parts]
    if kind in _BINARY and all(p[0] == "const" for p in done):
        return ("const", _BINARY[kind](done[0][1], done[1][1]))
    if kind == "not" and done[0][0] == "const":
        return ("const", not done[0][1])
    if kind in ("and", "or") and done[0][0] == "const":
        return done[1] if bool(done[0][1]) == (kind == "and") else done[0]
    if kind == "if" and done[0][0] == "const":
        return done[1] if done[0][1] else done[2]
    if kind == "all":
        flat: list[tuple] = []
        for p in done:
            for q in p[1:] if p[0] == "all" else [p]:
                constant = q[0] == "print" and q[1][0] == "const"
                if constant and flat and flat[-1][0] == "print" and flat[-1][1][0] == "const":
                    flat[-1] = ("print", ("const", _text(flat[-1][1][1]) + _text(q[1][1])))
                elif not constant or _text(q[1][1]):
                    flat.append(q)
        return ("all", *flat)
    return (kind, *done)


# ------------------------------------------------------------------ compiling
def _value(node: tuple) -> Callable[[dict], Any]:
    kind, *parts = node
    if kind == "const":
        constant = parts[0]
        return lambda scope: constant
    if kind == "name":
        name = parts[0]
        return lambda scope: scope.get(name)
    if kind == "field":
        of, key = _value(parts[0]), _value(parts[1])

        def field(scope: dict) -> Any:
            owner, k = of(scope), key(scope)
            if isinstance(owner, dict):
                return owner.get(k)
            return owner[k] if isinstance(owner, (list, tuple)) and isinstance(k, int) and k < len(owner) else None

        return field
    if kind == "filter":
        apply, inner = FILTERS[parts[0]], _value(parts[1])
        return lambda scope: apply(inner(scope))
    first, second = _value(parts[0]), _value(parts[1]) if len(parts) > 1 else None
    if kind == "not":
        return lambda scope: not first(scope)
    if kind == "and":
        return lambda scope: first(scope) and second(scope)
    if kind == "or":
        return lambda scope: first(scope) or second(scope)
    compute = _BINARY[kind]
    return lambda scope: compute(first(scope), second(scope))


Writer = Callable[[dict, Callable[[str, bool], None], bool], None]


def _writer(node: tuple) -> Writer:
    kind, *parts = node
    if kind == "print":
        value = _value(parts[0])
        return lambda scope, put, loss: put(_text(value(scope)), loss)
    if kind == "generation":
        inner = _writer(parts[0])
        return lambda scope, put, loss: inner(scope, put, True)
    if kind == "if":
        test, then, other = _value(parts[0]), _writer(parts[1]), _writer(parts[2])
        return lambda scope, put, loss: (then if test(scope) else other)(scope, put, loss)
    if kind == "for":
        name, items, inner = parts[0], _value(parts[1]), _writer(parts[2])

        def loop(scope: dict, put: Callable[[str, bool], None], loss: bool) -> None:
            values = items(scope) or ()
            for i, v in enumerate(values):
                place = {"first": i == 0, "last": i + 1 == len(values), "index0": i}
                inner(scope | {name: v, "loop": place}, put, loss)

        return loop
    steps = [_writer(p) for p in parts]

    def all_steps(scope: dict, put: Callable[[str, bool], None], loss: bool) -> None:
        for step in steps:
            step(scope, put, loss)

    return all_steps


class Template:
    """A compiled template."""

    def __init__(self, source: str = TEMPLATE):
        self.tree = fold(parse(source))
        self._run = _writer(self.tree)

    def render(self, **values: Any) -> tuple[str, list[tuple[int, int]]]:
        """The text, and the (start, end) of its parts under the loss mask; an
        empty part under the mask keeps its (empty) span."""
        out: list[str] = []
        spans: list[tuple[int, int]] = []
        at = 0

        def put(text: str, loss: bool) -> None:
            nonlocal at
            out.append(text)
            if loss:
                spans.append((at, at + len(text)))
            at += len(text)

        self._run(values, put, False)
        return "".join(out), spans


# ------------------------------------------------------------------- on Spark
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text made by ``TEMPLATE``."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        out.append((unescape_line(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return out


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, end>>) of each conversation.

    Turns are dealt out by conv_id and sorted on disk if need be; a task holds
    one conversation at a time, which is one training example."""
    prepare(conversations.sparkSession)
    Template(template)   # a faulty template fails here
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", span)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Template(template)
        conv, turns, held = None, [], False
        done: list[tuple] = []

        def close() -> None:
            text, spans = own.render(messages=turns)
            done.append((conv, text, [{"start": a, "end": b} for a, b in spans]))

        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if held and c != conv:
                    close()
                    turns = []
                conv, held = c, True
                turns.append({"role": role or "", "text": text or ""})
            if done:
                yield record_batch(dict(zip(schema.names, zip(*done, strict=True), strict=True)), schema)
                done.clear()
        if held:
            close()
            yield record_batch(dict(zip(schema.names, zip(*done, strict=True), strict=True)), schema)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text")
            .mapInArrow(run, "conv_id long, formatted string, loss array<struct<start:int,end:int>>"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold, read back from them alone."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                             len(text)))
            if rows:
                yield record_batch(dict(zip(names, zip(*rows, strict=True), strict=True)), schema)

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
