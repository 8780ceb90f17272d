"""A small sandboxed template language for conversations, compiled to Python closures.

    {{ expr }}                          the value, escaped
    {% for m in messages %} .. {% endfor %}
    {% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}
    {% set name = expr %}
    {% generation %} .. {% endgeneration %}   the text the loss is taken on
    {# comment #}                       a "-" inside a delimiter strips the blanks beside it

Expressions: strings, integers, true/false/none, names, ``a.b`` and ``a['b']`` (items of mappings
only, never attributes), ``+ ~ == != < <= > >= and or not in``, ``x if c else y`` and the filters in
``FILTERS``. Nothing else can be reached: no calls, no attributes, no imports. A template is parsed
into a tree, constant parts are folded, and each node becomes one closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any


class TemplateError(ValueError):
    """The template does not parse, or uses what the sandbox has not."""


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else len(_text(v)),
    "string": lambda v: _text(v),
}


class Verbatim(str):
    """Text written by the template itself: it is not escaped."""


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


# The tree.


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    expr: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Set:
    name: str
    expr: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


_PARTS = re.compile(r"(\{\{-?|\{%-?|\{#-?)")
_TOKEN = re.compile(
    r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|<=|>=|[-+~<>()\[\].|=]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


def _split(source: str) -> list[tuple[str, str]]:
    """('text' | 'out' | 'tag', content) pieces, with blanks stripped where asked."""
    pieces, at, strip = [], 0, False
    while at < len(source):
        found = _PARTS.search(source, at)
        text = source[at : found.start()] if found else source[at:]
        if strip:
            text = text.lstrip()
        if found and found[0].endswith("-"):
            text = text.rstrip()
        if text:
            pieces.append(("text", text))
        if not found:
            break
        close = {"{{": "}}", "{%": "%}", "{#": "#}"}[found[0][:2]]
        end = _closing(source, found.end(), close)
        inner = source[found.end() : end]
        strip = inner.endswith("-")
        if close != "#}":
            pieces.append(("out" if close == "}}" else "tag", inner.removesuffix("-").strip()))
        at = end + 2
    return pieces


def _closing(source: str, at: int, close: str) -> int:
    quote = ""
    while at < len(source):
        c = source[at]
        if quote:
            if c == "\\":
                at += 1
            elif c == quote:
                quote = ""
        elif close != "#}" and c in "'\"":
            quote = c
        elif source.startswith(close, at):
            return at
        at += 1
    raise TemplateError(f"missing {close}")


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str:
        if values and not self.peek(*values):
            raise TemplateError(f"expected {' or '.join(values)}")
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self):
        node = self.any()
        if self.peek("if"):
            self.take()
            test = self.any()
            self.take("else")
            node = Op("if", (test, node, self.choice()))
        return node

    def any(self):
        node = self.all()
        while self.peek("or"):
            self.take()
            node = Op("or", (node, self.all()))
        return node

    def all(self):
        node = self.negated()
        while self.peek("and"):
            self.take()
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        if self.peek("not"):
            self.take()
            return Op("not", (self.negated(),))
        return self.compared()

    def compared(self):
        node = self.joined()
        while self.peek("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            kind = self.take()
            if kind == "not":
                self.take("in")
                node = Op("not", (Op("in", (node, self.joined())),))
            else:
                node = Op(kind, (node, self.joined()))
        return node

    def joined(self):
        node = self.filtered()
        while self.peek("+", "~"):
            node = Op(self.take(), (node, self.filtered()))
        return node

    def filtered(self):
        node = self.path()
        while self.peek("|"):
            self.take()
            name = self.take()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Op("filter:" + name, (node,))
        return node

    def path(self):
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            node = Const(Verbatim(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S)))
        elif kind == "int":
            node = Const(int(value))
        elif kind == "name" and value in _WORDS:
            node = Const(_WORDS[value])
        elif kind == "name":
            node = Name(value)
        elif value == "(":
            node = self.choice()
            self.take(")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self.peek(".", "["):
            if self.take() == ".":
                if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                    raise TemplateError("a name must follow the dot")
                node = Item(node, Const(self.take()))
            else:
                node = Item(node, self.choice())
                self.take("]")
        return node


def parse(source: str) -> tuple:
    """The tree of a template."""
    pieces, at = _split(source), 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(pieces):
            kind, inner = pieces[at]
            at += 1
            if kind == "text":
                nodes.append(Text(inner))
            elif kind == "out":
                nodes.append(Output(_Expression(inner).whole()))
            else:
                word, _, rest = inner.partition(" ")
                if word in ends:
                    return tuple(nodes), inner
                nodes.append(tag(word, rest.strip()))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), ""

    def tag(word: str, rest: str):
        if word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not found:
                raise TemplateError(f"cannot read for {rest!r}")
            return For(found[1], _Expression(found[2]).whole(), block(("endfor",))[0])
        if word == "if":
            return condition(rest)
        if word == "set":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.S)
            if not found:
                raise TemplateError(f"cannot read set {rest!r}")
            return Set(found[1], _Expression(found[2]).whole())
        if word == "generation":
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"no tag {word!r}")

    def condition(test: str):
        then, end = block(("elif", "else", "endif"))
        word, _, rest = end.partition(" ")
        other: tuple = ()
        if word == "elif":
            other = (condition(rest),)
        elif word == "else":
            other = block(("endif",))[0]
        return If(_Expression(test).whole(), then, other)

    return block(())[0]


_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}


def _join(a: Any, b: Any) -> Any:
    """A list of parts, so that text of the template and text of a message stay apart."""
    if isinstance(a, int) and isinstance(b, int):
        return a + b
    return (a if isinstance(a, tuple) else (a,)) + (b if isinstance(b, tuple) else (b,))


def fold(node: Any) -> Any:
    """The same tree with constant expressions computed, constant branches chosen, texts merged."""
    if isinstance(node, tuple):
        out: list = []
        for part in map(fold, node):
            for one in part if isinstance(part, tuple) else (part,):
                if isinstance(one, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + one.value)
                elif not (isinstance(one, Text) and not one.value):
                    out.append(one)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(fold(a) for a in node.args)
        if node.kind == "if" and isinstance(args[0], Const):
            return args[1] if args[0].value else args[2]
        if all(isinstance(a, Const) for a in args) and node.kind not in ("+", "~"):
            return Const(_evaluate(Op(node.kind, args))({}))
        if node.kind in ("+", "~") and all(isinstance(a, Const) and isinstance(a.value, Verbatim) for a in args):
            return Const(Verbatim(args[0].value + args[1].value))
        return Op(node.kind, args)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Output):
        expr = fold(node.expr)
        if isinstance(expr, Const) and (isinstance(expr.value, Verbatim) or not isinstance(expr.value, str)):
            return Text(_text(expr.value))
        return Output(expr)
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, Set):
        return Set(node.name, fold(node.expr))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _evaluate(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Item):
        of, key = _evaluate(node.of), _evaluate(node.key)

        def item(env):
            held, k = of(env), key(env)
            if isinstance(held, dict):
                return held.get(k)
            return held[k] if isinstance(held, (list, tuple)) and isinstance(k, int) and k < len(held) else None

        return item
    args = [_evaluate(a) for a in node.args]
    if node.kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.kind == "or":
        return lambda env: args[0](env) or args[1](env)
    if node.kind == "not":
        return lambda env: not args[0](env)
    if node.kind == "if":
        return lambda env: args[1](env) if args[0](env) else args[2](env)
    if node.kind in ("+", "~"):
        return lambda env: _join(args[0](env), args[1](env))
    if node.kind.startswith("filter:"):
        run = FILTERS[node.kind[7:]]
        return lambda env: run(args[0](env))
    run = _BINARY[node.kind]
    return lambda env: run(args[0](env), args[1](env))


Chunk = tuple[str, bool]


def compile_template(source: str, escape: Callable[[str], str]) -> Callable[[dict], Iterator[Chunk]]:
    """A function from variables to (text, under the loss mask) pieces, made as they are needed.

    Text of the template stands as written; every other value goes through ``escape``.
    """
    tree = fold(parse(source))

    def steps(nodes: tuple, masked: bool) -> list[Callable[[dict], Iterator[Chunk]]]:
        return [step(n, masked) for n in nodes]

    def run(parts, env):
        for part in parts:
            yield from part(env)

    def step(node: Any, masked: bool) -> Callable[[dict], Iterator[Chunk]]:
        if isinstance(node, Text):
            piece = (node.value, masked)
            return lambda env: (piece,)
        if isinstance(node, Output):
            value = _evaluate(node.expr)

            def output(env):
                held = value(env)
                for part in held if isinstance(held, tuple) else (held,):
                    text = _text(part)
                    yield (text if isinstance(part, Verbatim) else escape(text)), masked

            return output
        if isinstance(node, Set):
            name, value = node.name, _evaluate(node.expr)

            def put(env):
                env[name] = value(env)
                return ()

            return put
        if isinstance(node, If):
            test, then, other = _evaluate(node.test), steps(node.then, masked), steps(node.other, masked)
            return lambda env: run(then if test(env) else other, env)
        if isinstance(node, Generation):
            body = steps(node.body, True)
            return lambda env: run(body, env)
        name, over, body = node.name, _evaluate(node.over), steps(node.body, masked)

        def loop(env):
            for value in over(env) or ():
                env[name] = value
                yield from run(body, env)

        return loop

    parts = steps(tree, False)
    return lambda variables: run(parts, dict(variables))
