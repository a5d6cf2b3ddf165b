"""A compiler for chat templates (operator 11): source -> syntax tree -> folded tree -> Python closures.

The language is a small sandboxed one.  ``{{ expression }}`` puts out a value, ``{% for m in messages %}``,
``{% if %} / {% elif %} / {% else %}`` and ``{% generation %}`` nest, a ``-`` inside a tag's brace trims the white
space next to it.  Expressions know strings, integers, ``true false none``, names, fields of a message, ``~`` (joins
texts), ``== != in not and or``, parentheses and the filters of ``FILTERS``.  There are no calls, subscripts,
assignments or imports, a field is a key of a message and never a Python attribute, and the only loop runs over the
messages: a template always ends and reaches nothing but what it is given.

Constant expressions are computed once, constant tests choose their branch, and neighbouring literals are one.
A closure yields (text, under the loss mask) pairs, so a conversation is never held as a whole.

``escape`` puts a backslash before each backslash and each control string, ``unescape`` takes it away.  Control
strings may not overlap themselves or each other; then no text can form one next to what the template writes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple


class TemplateError(ValueError):
    """The template is not one of the language."""


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    path: tuple[str, ...]


class Op(NamedTuple):
    kind: str
    parts: tuple


class Out(NamedTuple):
    value: Any
    masked: bool


class If(NamedTuple):
    test: Any
    then: tuple
    other: tuple


class Loop(NamedTuple):
    name: str
    body: tuple


OPERATORS: dict[str, Callable] = {
    "~": lambda a, b: _shown(a) + _shown(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "in": lambda a, b: _shown(a) in _shown(b), "not": lambda a: not a,
    "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}

FILTERS: dict[str, Callable] = {
    "trim": lambda x: _shown(x).strip(), "upper": lambda x: _shown(x).upper(), "lower": lambda x: _shown(x).lower(),
    "capitalize": lambda x: _shown(x).capitalize(), "default": lambda x, other: other if x is None else x,
    "length": lambda x: len(_shown(x)),
}

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[~|().,]))", re.S)
_WORDS = {"true": True, "false": False, "none": None}
_LETTERS = {"n": "\n", "t": "\t"}


def _shown(x: Any) -> str:
    return "" if x is None else str(x)


def escaper(controls: Iterable[str]) -> Callable[[Any], str]:
    """The reversible escape of the given control strings."""
    found = re.compile("|".join(map(re.escape, ["\\", *sorted(controls)])))
    return lambda x: found.sub(lambda m: "\\" + m[0], _shown(x))


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def _check_controls(controls: Iterable[str]) -> None:
    for a in controls:
        for b in controls:
            if not a or "\\" in a or any(a[k:] == b[:len(a) - k] for k in range(1, len(a))) or a != b and a in b:
                raise TemplateError(f"control strings {a!r} and {b!r} may not overlap")


# ---------------------------------------------------------------- source -> tree

class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:]!r}")
            self.tokens.append(m)
            at = m.end()
        self.at = 0

    def next_is(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and not self.tokens[self.at][1] and self.tokens[self.at][0].strip() in texts:
            self.at += 1
            return self.tokens[self.at - 1][0].strip()
        return None

    def whole(self):
        tree = self.chain(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"not understood: {self.tokens[self.at][0]!r}")
        return tree

    LEVELS = (("or",), ("and",), ("==", "!=", "in"), ("~",))

    def chain(self, level: int):
        if level == len(self.LEVELS):
            return self.filtered()
        if level == 2 and self.next_is("not"):
            return Op("not", (self.chain(level),))
        left = self.chain(level + 1)
        while op := self.next_is(*self.LEVELS[level]):
            left = Op(op, (left, self.chain(level + 1)))
        return left

    def filtered(self):
        tree = self.primary()
        while self.next_is("|"):
            name, args = self.word(), []
            if self.next_is("("):
                args.append(self.chain(0))
                while self.next_is(","):
                    args.append(self.chain(0))
                self.need(")")
            tree = Op("|" + name, (tree, *args))
        return tree

    def primary(self):
        if self.next_is("("):
            tree = self.chain(0)
            self.need(")")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends too early")
        text, number, word, _ = self.tokens[self.at].groups()
        if text:
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _LETTERS.get(m[1], m[1]), text[1:-1], flags=re.S))
        if number:
            self.at += 1
            return Const(int(number))
        path = [self.word()]
        if path[0] in _WORDS:
            return Const(_WORDS[path[0]])
        while self.next_is("."):
            path.append(self.word())
        return Name(tuple(path))

    def word(self) -> str:
        word = self.tokens[self.at][3] if self.at < len(self.tokens) else None
        if not word or word.startswith("_"):
            raise TemplateError("a name was expected")
        self.at += 1
        return word

    def need(self, text: str) -> None:
        if not self.next_is(text):
            raise TemplateError(f"{text!r} was expected")


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """Literals, expressions and statements in order, trimmed where a tag says so."""
    at, trim = 0, ""
    for m in _TAG.finditer(source):
        is_value = m[2] is not None
        left, inner, right = m.group(1, 2, 3) if is_value else m.group(4, 5, 6)
        text = source[at:m.start()]
        text = text.lstrip() if trim else text
        yield "text", text.rstrip() if left else text
        yield ("value" if is_value else "tag"), inner.strip()
        at, trim = m.end(), right
    yield "text", source[at:].lstrip() if trim else source[at:]


def parsed(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces = iter([*_pieces(source), ("end", "")])

    def block(ends: tuple[str, ...], masked: bool, inside: bool) -> tuple[list, str]:
        nodes: list = []
        for kind, inner in pieces:
            word, _, rest = inner.partition(" ")
            if kind == "text":
                nodes.append(Out(Const(inner), masked))
            elif kind == "value":
                nodes.append(Out(_Expression(inner).whole(), masked))
            elif (kind == "end" or word in ends) and (kind != "end" or not ends):
                return nodes, inner
            elif kind == "end":
                raise TemplateError(f"{' or '.join(ends)} is missing")
            elif word == "generation" and not masked:
                nodes += block(("endgeneration",), True, inside)[0]
            elif word == "for" and (m := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+messages", rest.strip())) and not inside:
                nodes.append(Loop(m[1], tuple(block(("endfor",), masked, True)[0])))
            elif word == "if":
                nodes.append(branch(rest, masked, inside))
            else:
                raise TemplateError(f"not allowed here: {inner!r}")
        raise TemplateError("unreachable")

    def branch(test: str, masked: bool, inside: bool) -> If:
        then, end = block(("elif", "else", "endif"), masked, inside)
        word, _, rest = end.partition(" ")
        other: list = []
        if word == "elif":
            other = [branch(rest, masked, inside)]
        elif word == "else":
            other = block(("endif",), masked, inside)[0]
        return If(_Expression(test).whole(), tuple(then), tuple(other))

    return tuple(block((), False, False)[0])


# ---------------------------------------------------------------- tree -> folded tree -> closures

def folded(node, functions: dict[str, Callable]):
    """The tree with constant expressions computed, constant tests decided and neighbouring literals joined."""
    if isinstance(node, Op):
        parts = tuple(folded(p, functions) for p in node.parts)
        if node.kind not in functions:
            raise TemplateError(f"no such filter: {node.kind[1:]}")
        if all(isinstance(p, Const) for p in parts):
            return Const(functions[node.kind](*(p.value for p in parts)))
        return Op(node.kind, parts)
    if isinstance(node, Out):
        value = folded(node.value, functions)
        return Out(Const(_shown(value.value)) if isinstance(value, Const) else value, node.masked)
    if isinstance(node, If):
        test = folded(node.test, functions)
        then, other = (folded(b, functions) for b in (node.then, node.other))
        if isinstance(test, Const):
            return then if test.value else other
        return If(test, then, other)
    if isinstance(node, Loop):
        return Loop(node.name, folded(node.body, functions))
    if type(node) is tuple:
        out: list = []
        for child in node:
            child = folded(child, functions)
            for x in child if type(child) is tuple else (child,):
                last = out[-1] if out else None
                if isinstance(x, Out) and isinstance(x.value, Const):
                    if not x.value.value:
                        continue
                    if isinstance(last, Out) and isinstance(last.value, Const) and last.masked == x.masked:
                        out[-1] = Out(Const(last.value.value + x.value.value), x.masked)
                        continue
                out.append(x)
        return tuple(out)
    return node


def _value(node, functions: dict[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        first, rest = node.path[0], node.path[1:]

        def look(env):
            x = env.get(first)
            for key in rest:
                x = x.get(key) if isinstance(x, dict) else None
            return x
        return look
    f, args = functions[node.kind], [_value(p, functions) for p in node.parts]
    if node.kind in ("and", "or"):
        stop = node.kind == "or"
        return lambda env: x if bool(x := args[0](env)) == stop else args[1](env)
    if len(args) == 1:
        a = args[0]
        return lambda env: f(a(env))
    return lambda env: f(*[a(env) for a in args])


def _closure(nodes: tuple, functions: dict[str, Callable]) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    steps = []
    for n in nodes:
        if isinstance(n, Out) and isinstance(n.value, Const):
            steps.append(lambda env, pair=((n.value.value, n.masked),): pair)
        elif isinstance(n, Out):
            steps.append(lambda env, v=_value(n.value, functions), m=n.masked: ((_shown(v(env)), m),))
        else:
            steps.append(lambda env, t=_value(n.test, functions), a=_closure(n.then, functions), b=_closure(n.other, functions):
                         (a if t(env) else b)(env))

    def run(env: dict) -> Iterator[tuple[str, bool]]:
        for step in steps:
            yield from step(env)
    return run


def _names(node) -> set[str]:
    if isinstance(node, Name):
        return {node.path[0]}
    return set().union(*map(_names, node)) if isinstance(node, tuple) else set()


class Template:
    """A compiled template: what stands before the loop, its body for one message, and what stands after it.

    Messages are rendered one by one, so a stretch of a long conversation can be rendered without the rest.
    ``edges`` says whether the template needs to know where a conversation begins and ends.
    """

    def __init__(self, source: str, controls: Iterable[str] = (), variables: dict[str, Any] | None = None):
        controls = tuple(controls)
        _check_controls(controls)
        escape = escaper(controls)
        functions = OPERATORS | {"|" + k: f for k, f in FILTERS.items()}
        functions["|escape"] = lambda x, *more: (escaper([*controls, *more]) if more else escape)(x)
        self.tree = folded(parsed(source), functions)
        loops = [k for k, n in enumerate(self.tree) if isinstance(n, Loop)]
        if len(loops) != 1 or any(isinstance(n, If) and _has_loop(n) for n in self.tree):
            raise TemplateError("a template has one loop over the messages, which stands in no other tag")
        loop = self.tree[loops[0]]
        head, tail = self.tree[:loops[0]], self.tree[loops[0] + 1:]
        known = set(variables or {})
        for nodes, names in ((head + tail, known), (loop.body, known | {loop.name, "loop"})):
            if unknown := _names(nodes) - names:
                raise TemplateError(f"unknown names: {', '.join(sorted(unknown))}")
        self.edges = bool(head or tail or "loop" in _names(loop.body))
        self._env, self._loop = dict(variables or {}), loop.name
        self._head, self._body, self._tail = (_closure(x, functions) for x in (head, loop.body, tail))

    def message(self, message: dict, first: bool, last: bool) -> Iterator[tuple[str, bool]]:
        """What one message gives: (text, under the loss mask) pairs, with the head or the tail at an end."""
        if first:
            yield from self._head(self._env)
        yield from self._body(self._env | {self._loop: message, "loop": {"first": first, "last": last}})
        if last:
            yield from self._tail(self._env)

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation and its masked spans (code points, end exclusive)."""
        pairs = (p for k, m in enumerate(messages) for p in self.message(m, k == 0, k == len(messages) - 1))
        return joined(pairs)


def _has_loop(node) -> bool:
    return isinstance(node, Loop) or isinstance(node, tuple) and any(map(_has_loop, node))


def joined(pairs: Iterable[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of the pairs, and a span for each masked one (an empty one too)."""
    parts, spans, at = [], [], 0
    for text, masked in pairs:
        if masked:
            spans.append((at, at + len(text)))
        parts.append(text)
        at += len(text)
    return "".join(parts), spans
