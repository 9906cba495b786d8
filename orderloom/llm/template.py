"""A small sandboxed template language, compiled to Python closures.

    text  {{ expression }}  {% for x in items %}...{% endfor %}
    {% if test %}...{% elif test %}...{% else %}...{% endif %}
    {% generation %}...{% endgeneration %}

Expressions know literals, names, ``a.b`` (a key of a mapping, nothing else), ``| filter``,
``+``, ``==``, ``!=``, ``in``, ``not``, ``and``, ``or`` and parentheses. There are no calls
and no access to Python objects. Loops offer ``loop.index0``, ``loop.first`` and
``loop.last`` and take one item at a time, so their input may be longer than memory.

``compile_template`` parses to a syntax tree, folds constants, and turns the tree into
closures. Rendering yields (text, generated) pieces; ``generated`` marks what stands inside
a generation block.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

Piece = tuple[str, bool]
Scope = dict[str, object]


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    name: str


@dataclass(frozen=True)
class Apply:
    """A pure function of parts: an operator or a filter."""

    do: str
    parts: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: object) -> str:
    return "" if value is None else str(value)


PURE: dict[str, Callable] = {
    "==": operator.eq,
    "!=": operator.ne,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "in": lambda a, b: a in b if b else False,
    "not": operator.not_,
}
FILTERS: dict[str, Callable] = {
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "trim": lambda v: _text(v).strip(),
}

# Parsing

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|[.|+()]))")
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, object]]:
    found, at = [], 0
    while source[at:].strip():
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, single, double, word, mark = m.groups()
        if number:
            found.append(("const", int(number)))
        elif single is not None or double is not None:
            raw = single if single is not None else double
            found.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), raw, flags=re.DOTALL)))
        elif word in _WORDS:
            found.append(("const", _WORDS[word]))
        else:
            found.append(("word", word) if word else ("mark", mark))
        at = m.end()
    return found


class _Expression:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.at, self.filters, self.source = _tokens(source), 0, filters, source

    def peek(self) -> object:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" else None

    def take(self, *wanted: str) -> object:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> object:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"cannot read all of {self.source!r}")
        return tree

    def either(self) -> object:
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self) -> object:
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self) -> object:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> object:
        tree = self.joined()
        while mark := self.take("==", "!=", "in"):
            tree = Apply(str(mark), (tree, self.joined()))
        return tree

    def joined(self) -> object:
        tree = self.filtered()
        while self.take("+"):
            tree = Apply("+", (tree, self.filtered()))
        return tree

    def filtered(self) -> object:
        tree = self.single()
        while True:
            if self.take("."):
                tree = Key(tree, self.word())
            elif self.take("|"):
                name = self.word()
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                tree = Apply(name, (tree,))
            else:
                return tree

    def word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "word":
            self.at += 1
            return str(self.tokens[self.at - 1][1])
        raise TemplateError(f"a name is missing in {self.source!r}")

    def single(self) -> object:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError(f"a bracket is open in {self.source!r}")
            return tree
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        return Name(self.word())


class _Parser:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters, self.items, at = filters, [], 0
        for m in _TAG.finditer(source):
            if m.start() > at:
                self.items.append(("text", source[at : m.start()]))
            self.items.append(("output", m[1]) if m[1] is not None else ("tag", m[2].strip()))
            at = m.end()
        if at < len(source):
            self.items.append(("text", source[at:]))
        self.at = 0

    def expression(self, source: str) -> object:
        return _Expression(source, self.filters).whole()

    def block(self, *ends: str) -> tuple[tuple, str]:
        """Nodes up to one of the end tags, and that tag."""
        nodes = []
        while self.at < len(self.items):
            kind, value = self.items[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Output(Const(value)))
            elif kind == "output":
                nodes.append(Output(self.expression(value)))
            else:
                word = value.split(None, 1)[0] if value else ""
                if word in ends:
                    return tuple(nodes), value
                nodes.append(self.tag(word, value[len(word) :].strip()))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(nodes), ""

    def tag(self, word: str, rest: str) -> object:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return For(m[1], self.expression(m[2]), self.block("endfor")[0])
        if word == "if":
            return self.branch(rest)
        if word == "generation":
            return Generation(self.block("endgeneration")[0])
        raise TemplateError(f"no tag {word!r}")

    def branch(self, test: str) -> If:
        then, end = self.block("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (self.branch(end[4:]),)
        elif end.startswith("else"):
            other = self.block("endif")[0]
        return If(self.expression(test), then, other)


# Folding

def _fold_value(node: object, pure: Mapping[str, Callable]) -> object:
    if isinstance(node, Key):
        of = _fold_value(node.of, pure)
        return Const(_key(of.value, node.name)) if isinstance(of, Const) else Key(of, node.name)
    if not isinstance(node, Apply):
        return node
    parts = tuple(_fold_value(p, pure) for p in node.parts)
    if node.do in ("and", "or"):
        if not isinstance(parts[0], Const):
            return Apply(node.do, parts)
        return parts[1] if bool(parts[0].value) == (node.do == "and") else parts[0]
    if all(isinstance(p, Const) for p in parts):
        return Const(pure[node.do](*[p.value for p in parts]))
    return Apply(node.do, parts)


def fold(nodes: Iterable, pure: Mapping[str, Callable]) -> tuple:
    """Constants worked out, branches of constant tests chosen, neighbouring texts joined."""
    found: list = []
    for node in nodes:
        if isinstance(node, Output):
            value = _fold_value(node.value, pure)
            made: tuple = (Output(Const(_text(value.value)) if isinstance(value, Const) else value),)
        elif isinstance(node, If):
            test = _fold_value(node.test, pure)
            then, other = fold(node.then, pure), fold(node.other, pure)
            made = (then if test.value else other) if isinstance(test, Const) else (If(test, then, other),)
        elif isinstance(node, For):
            made = (For(node.name, _fold_value(node.items, pure), fold(node.body, pure)),)
        else:
            made = (Generation(fold(node.body, pure)),)
        for one in made:
            fixed = isinstance(one, Output) and isinstance(one.value, Const)
            if fixed and found and isinstance(found[-1], Output) and isinstance(found[-1].value, Const):
                found[-1] = Output(Const(found[-1].value.value + one.value.value))
            elif not fixed or one.value.value:
                found.append(one)
    return tuple(found)


# Closures

def _key(of: object, name: str) -> object:
    return of.get(name) if isinstance(of, Mapping) else None


def _value(node: object, pure: Mapping[str, Callable]) -> Callable[[Scope], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Key):
        of, name = _value(node.of, pure), node.name
        return lambda scope: _key(of(scope), name)
    parts = [_value(p, pure) for p in node.parts]
    if node.do == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.do == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    do = pure[node.do]
    if len(parts) == 1:
        only = parts[0]
        return lambda scope: do(only(scope))
    first, second = parts
    return lambda scope: do(first(scope), second(scope))


Renderer = Callable[[Scope, bool], Iterator[Piece]]


def _body(nodes: tuple, pure: Mapping[str, Callable]) -> Renderer:
    steps = [_statement(n, pure) for n in nodes]

    def run(scope: Scope, generated: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, generated)

    return run


def _statement(node: object, pure: Mapping[str, Callable]) -> Renderer:
    if isinstance(node, Output):
        value = _value(node.value, pure)
        return lambda scope, generated: iter(((_text(value(scope)), generated),))
    if isinstance(node, Generation):
        inside = _body(node.body, pure)
        return lambda scope, generated: inside(scope, True)
    if isinstance(node, If):
        test, then, other = _value(node.test, pure), _body(node.then, pure), _body(node.other, pure)
        return lambda scope, generated: (then if test(scope) else other)(scope, generated)
    name, items, body = node.name, _value(node.items, pure), _body(node.body, pure)

    def loop(scope: Scope, generated: bool) -> Iterator[Piece]:
        rest = iter(items(scope) or ())
        ended = object()
        item, index = next(rest, ended), 0
        while item is not ended:
            following = next(rest, ended)
            about = {"index0": index, "first": index == 0, "last": following is ended}
            yield from body({**scope, name: item, "loop": about}, generated)
            item, index = following, index + 1

    return loop


@dataclass(frozen=True)
class Template:
    tree: tuple
    run: Renderer

    def render(self, **values: object) -> Iterator[Piece]:
        return self.run(values, False)


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Template:
    pure = {**PURE, **FILTERS, **(filters or {})}
    nodes, _ = _Parser(source, {**FILTERS, **(filters or {})}).block()
    tree = fold(nodes, pure)
    return Template(tree, _body(tree, pure))
