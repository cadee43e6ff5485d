"""Chat formatting with templates in a small sandboxed language.

A template is text with ``{{ expression }}``, ``{# comment #}``, ``{% for m in messages %}``,
``{% if %}``/``{% elif %}``/``{% else %}``, ``{% set x = ... %}`` and
``{% generation %}`` ... ``{% endgeneration %}``, which marks what a model is to
learn. A ``-`` inside a bracket takes the white space on its side. Expressions have
strings, whole numbers, lists, names, ``m.role`` and ``m['role']``, indexes and slices,
``or and not``, comparisons and ``in``, ``+ - ~ * // %``, a condition ``a if c else b``, tests
(``x is defined``) and the filters and string methods in the tables below. There is
no way to Python objects. Anything else raises ``TemplateError``.

A template is parsed to a tree, constants are folded, and the tree becomes nested
Python closures that yield pieces of output. Turns are streamed with one turn of
look-ahead (``loop.last``, ``loop.nextitem``), so a conversation of any length needs the
memory of two turns, and of the first ones if the template indexes them. What
would need the whole conversation (its length, its end, a second loop) raises.
With ``strict``, which ``formatted`` uses, names and members that nobody set raise unless
they are asked for by ``is defined`` or ``default``; else they are empty. As in the
templates models are published with, what a loop's body sets is gone after the turn,
but for members of a ``namespace()``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import in_arrow, width

#: Marks of turns. ``escape`` keeps them, and the escape sign itself, out of texts.
START, MIDDLE, END = "<|turn|>", "<|says|>", "<|over|>"
#: Control strings of templates; each gets the escape sign after its first character.
CONTROLS = (START, MIDDLE, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
SIGN = "\\"
TEMPLATE = (
    "{% for m in messages %}" + START + "{{ m.role | escape }}" + MIDDLE
    + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    + "{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)

_CONTROL = re.compile("|".join(map(re.escape, sorted((*CONTROLS, SIGN), key=len, reverse=True))))
_STRING = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
_TAG = re.compile(rf"\{{#.*?#\}}|\{{\{{(?:{_STRING}|[^'\"])*?\}}\}}|\{{%(?:{_STRING}|[^'\"])*?%\}}", re.S)
_TOKEN = re.compile(rf"\s*(?:(\d+)|({_STRING})|([A-Za-z]\w*)|(==|!=|<=|>=|//|[-+*%~|.,:=<>\[\]()]))", re.S)
_WORDS = {"if", "else", "and", "or", "not", "in", "is"}
_CONSTANTS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}

Node = tuple
Piece = tuple[str, bool]


def escape(text: str) -> str:
    """Text without control strings: an escape sign goes after the first character of each, and is doubled itself."""
    return _CONTROL.sub(lambda m: m[0][0] + SIGN + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of ``escape``: the sign after any character of a control string's start, or after itself, goes."""
    out, at = [], 0
    while (k := text.find(SIGN, at)) >= 0:
        if text[k : k + 2] == SIGN + SIGN:  # a sign of the text's own
            out.append(text[at : k + 1])
            at = k + 2
        else:
            out.append(text[at:k])
            at = k + 1
    return "".join(out) + text[at:]


class TemplateError(ValueError):
    """The template is not in the language, or asks for something that is not there."""


class Missing(TemplateError):
    """A name or a member that nobody set."""


class _Unset:
    """What names and members that nobody set are worth where the template is not strict."""

    def __bool__(self) -> bool:
        return False


UNSET = _Unset()


class Namespace(dict):
    """Members that a loop's body may set for the turns after it."""


class Stream:
    """The turns of a conversation in order, read once: the first ``keep`` and those next to the loop's are at hand."""

    def __init__(self, turns: Iterable[dict], keep: int):
        self.turns, self.keep = iter(turns), keep
        self.first: list[dict] = []
        self.waiting: deque[dict] = deque()
        self.near: dict[int, Any] = {}
        self.begun = False

    def pull(self) -> bool:
        turn = next(self.turns, None)
        if turn is None:
            return False
        self.waiting.append(turn)
        if len(self.first) < self.keep:
            self.first.append(turn)
        return True

    def at(self, k: int) -> Any:
        if k in self.near:
            return self.near[k]
        if not 0 <= k < self.keep:
            raise TemplateError(f"turn {k} is not at hand: turns are streamed, the first {self.keep} and the loop's neighbours can be indexed")
        while len(self.first) <= k and self.pull():
            pass
        return self.first[k] if k < len(self.first) else UNSET

    def some(self, start: int) -> bool:
        """Whether there are turns from ``start`` on."""
        while not self.begun and len(self.waiting) <= start and self.pull():
            pass
        return self.begun or len(self.waiting) > start

    def loop(self, start: int) -> Iterator[tuple[dict, Any, Any]]:
        if self.begun:
            raise TemplateError("turns are streamed: a template loops over them once")
        self.begun, k, before = True, 0, UNSET
        while self.waiting or self.pull():
            now = self.waiting.popleft()
            after = self.waiting[0] if self.waiting or self.pull() else UNSET
            self.near = {k - 1: before, k: now, k + 1: after} if k else {0: now, 1: after}
            if k >= start:
                yield now, before if k > start else UNSET, after
            before, k = now, k + 1


class Turns:
    """The turns of a stream from ``start`` on: what a template knows as messages and slices of them."""

    def __init__(self, stream: Stream, start: int = 0):
        self.stream, self.start = stream, start

    def __bool__(self) -> bool:
        return self.stream.some(self.start)


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, string, name, sign = m.groups()
        if number:
            out.append(("const", int(number)))
        elif string:
            out.append(("const", re.sub(r"\\(.)", _unescaped, string[1:-1], flags=re.S)))
        elif name in _CONSTANTS:
            out.append(("const", _CONSTANTS[name]))
        elif name:
            out.append(("word" if name in _WORDS else "name", name))
        else:
            out.append(("sign", sign))
        at = m.end()
    return out


def _unescaped(m: re.Match) -> str:
    if m[1] not in _ESCAPES:
        raise TemplateError(f"no escape {m[0]!r} in strings")
    return _ESCAPES[m[1]]


class _Expression:
    """Recursive descent over one expression; ``*`` binds before ``~``, that before ``+``, that before comparisons."""

    def __init__(self, source: str):
        self.rest = _tokens(source)[::-1]

    def peek(self, *values: str) -> bool:
        return bool(self.rest) and self.rest[-1][0] in ("sign", "word") and self.rest[-1][1] in values

    def take(self, value: str) -> None:
        if not self.peek(value):
            raise TemplateError(f"{value!r} is missing")
        self.rest.pop()

    def took(self, value: str) -> bool:
        found = self.peek(value)
        if found:
            self.rest.pop()
        return found

    def name(self) -> str:
        kind, value = self.rest.pop() if self.rest else ("", "")
        if kind != "name":
            raise TemplateError(f"a name is missing before {value!r}")
        return value

    def whole(self) -> Node:
        node = self.choice()
        if self.rest:
            raise TemplateError(f"{self.rest[-1][1]!r} is too much")
        return node

    def choice(self) -> Node:
        node = self.either()
        if self.took("if"):
            test = self.either()
            self.take("else")
            node = ("op", "choice", test, node, self.choice())
        return node

    def either(self) -> Node:
        return self.left(("or",), lambda: self.left(("and",), self.negated))

    def left(self, signs: tuple[str, ...], below: Callable[[], Node]) -> Node:
        node = below()
        while self.peek(*signs):
            sign = self.rest.pop()[1]
            node = ("op", sign, node, below())
        return node

    def negated(self) -> Node:
        if self.took("not"):
            return ("op", "not", self.negated())
        node = self.added()
        if self.peek("==", "!=", "<", "<=", ">", ">=", "in"):
            sign = self.rest.pop()[1]
            return ("op", sign, node, self.added())
        if self.took("not"):
            self.take("in")
            return ("op", "not", ("op", "in", node, self.added()))
        return node

    def added(self) -> Node:
        return self.left(("+", "-"), lambda: self.left(("~",), lambda: self.left(("*", "//", "%"), self.signed)))

    def signed(self) -> Node:
        if self.took("-"):
            return ("op", "negative", self.signed())
        node = self.member()
        while self.peek("|", "is"):
            if self.rest.pop()[1] == "|":
                name = self.name()
                if name not in FILTERS and name != "default":
                    raise TemplateError(f"no filter {name!r}")
                args = self.several(")") if self.took("(") else []
                if len(args) != (name == "default"):
                    raise TemplateError(f"the filter {name!r} has {len(args)} arguments")
                node = ("op", "|" + name, node, *args)
            else:
                denied = self.took("not")
                kind, name = self.rest.pop() if self.rest else ("", "")
                name = str(name).lower()
                if kind not in ("name", "const") or name not in TESTS:
                    raise TemplateError(f"no test {name!r}")
                node = ("op", "is " + name, node)
                node = ("op", "not", node) if denied else node
        return node

    def several(self, end: str) -> list[Node]:
        """Expressions between commas, up to the closing sign."""
        nodes: list[Node] = []
        while not self.took(end):
            if nodes:
                self.take(",")
                if self.took(end):
                    break
            nodes.append(self.choice())
        return nodes

    def member(self) -> Node:
        if not self.rest:
            raise TemplateError("an expression ends too early")
        kind, value = self.rest.pop()
        if kind == "const":
            node: Node = ("const", value)
        elif kind == "name":
            node = self.function(value) if self.took("(") else ("name", value)
        elif value == "(":
            node = self.choice()
            self.take(")")
        elif value == "[":
            node = ("op", "list", *self.several("]"))
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self.peek(".", "["):
            if self.rest.pop()[1] == "[":
                node = self.index(node)
                continue
            name = self.name()
            if not self.took("("):
                node = ("op", "item", node, ("const", name))
            elif name in METHODS:
                node = ("op", "." + name, node, *self.several(")"))
            else:
                raise TemplateError(f"no method {name!r}")
        return node

    def index(self, node: Node) -> Node:
        low = ("const", None) if self.peek(":") else self.choice()
        if self.took("]"):
            return ("op", "item", node, low)
        self.take(":")
        high = ("const", None) if self.peek("]") else self.choice()
        self.take("]")
        return ("op", "slice", node, low, high)

    def function(self, name: str) -> Node:
        if name == "raise_exception":
            args = self.several(")")
            if len(args) == 1:
                return ("op", "raise", *args)
        if name == "namespace":
            names, nodes = [], []
            while not self.took(")"):
                if names:
                    self.take(",")
                names.append(self.name())
                self.take("=")
                nodes.append(self.choice())
            return ("space", tuple(names), *nodes)
        raise TemplateError(f"no function {name!r} of these arguments")


def _parts(source: str, lines: bool) -> Iterator[tuple[str, str]]:
    """Texts, prints and tags of a template, white space that brackets take already gone."""
    if lines and source.endswith("\n"):
        source = source[:-1]
    at, after = 0, ""
    for m in (*_TAG.finditer(source), None):
        start, end = m.span() if m else (len(source),) * 2
        text = source[at:start]
        if any(sign in text for sign in ("{{", "{%", "{#")):
            raise TemplateError(f"a bracket is not closed after {text[-40:]!r}")
        if after == "-":
            text = text.lstrip()
        elif after == "line":
            text = text.removeprefix("\n")
        if m is None:
            yield "text", text
            return
        tag = m[0][2:-2]
        alone = lines and m[0][1] != "{"
        if tag.startswith("-"):
            text, tag = text.rstrip(), tag[1:]
        elif alone and not source[source.rfind("\n", 0, start) + 1 : start].strip(" \t"):
            text = text.rstrip(" \t")
        after = "-" if tag.endswith("-") else "line" if alone else ""
        yield "text", text
        if m[0][1] != "#":
            yield "print" if m[0][1] == "{" else "tag", tag.removesuffix("-")
        at = end


def parse(source: str, lines: bool = False) -> Node:
    """The syntax tree of a template.

    With ``lines`` a tag or comment takes the blanks that begin its line and the
    line break behind it, and the template's last line break goes, as is usual
    for templates published with models.
    """
    parts, at = list(_parts(source, lines)), 0

    def block(ends: tuple[str, ...]) -> tuple[Node, str]:
        nonlocal at
        nodes: list[Node] = []
        while at < len(parts):
            kind, part = parts[at]
            at += 1
            if kind == "print":
                nodes.append(("print", _Expression(part).whole()))
            elif kind == "tag":
                tag = part.strip()
                word = tag.split(None, 1)[0] if tag else ""
                if word in ends and (word == tag or word == "elif"):
                    return ("block", *nodes), tag
                nodes.append(statement(word, tag))
            elif part:
                nodes.append(("print", ("const", part)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("block", *nodes), ""

    def statement(word: str, tag: str) -> Node:
        if word == "for" and (m := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s(.+)", tag, re.S)):
            return ("for", m[1], _Expression(m[2]).whole(), block(("endfor",))[0])
        if word == "if":
            return branch(tag[2:])
        if word == "set" and (m := re.fullmatch(r"set\s+([A-Za-z]\w*)(?:\.([A-Za-z]\w*))?\s*=(?!=)(.*)", tag, re.S)):
            return ("set", (m[1], m[2]), _Expression(m[3]).whole())
        if tag == "generation":
            return ("generation", block(("endgeneration",))[0])
        raise TemplateError(f"unknown tag {tag!r}")

    def branch(condition: str) -> Node:
        test = _Expression(condition).whole()
        body, end = block(("elif", "else", "endif"))
        if end.startswith("elif"):
            return ("if", test, body, branch(end[4:]))
        return ("if", test, body, block(("endif",))[0] if end == "else" else ("block",))

    return block(())[0]


def text_of(value: Any) -> str:
    if value is UNSET:
        return ""
    if value is None or isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__.lower()} is no text")


def _alike(sign: str, kinds: tuple[type, ...], apply: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    """A binary operation on two values of one of these types; others raise."""

    def run(a: Any, b: Any) -> Any:
        if type(a) is not type(b) or type(a) not in kinds:
            raise TemplateError(f"no {sign!r} of {type(a).__name__} and {type(b).__name__}")
        try:
            return apply(a, b)
        except ZeroDivisionError:
            raise TemplateError(f"{a} {sign} 0") from None

    return run


def _within(a: Any, b: Any) -> bool:
    if isinstance(b, (list, dict)) or isinstance(a, str) and isinstance(b, str):
        return a in b
    raise TemplateError(f"no 'in' of {type(a).__name__} and {type(b).__name__}")


def _item(whole: Any, key: Any) -> Any:
    if isinstance(whole, dict):
        return whole.get(key, UNSET) if isinstance(key, str) else UNSET
    if type(key) is int and isinstance(whole, Turns):
        if key < 0:
            raise TemplateError("turns are streamed: they are not counted from the end")
        return whole.stream.at(whole.start + key)
    if type(key) is int and isinstance(whole, (str, list)):
        return whole[key] if -len(whole) <= key < len(whole) else UNSET
    return UNSET


def _slice(whole: Any, low: Any, high: Any) -> Any:
    if any(type(k) is not int and k is not None for k in (low, high)) or not isinstance(whole, (str, list, Turns)):
        raise TemplateError(f"no slice {low}:{high} of {type(whole).__name__}")
    if not isinstance(whole, Turns):
        return whole[low:high]
    if high is not None or (low or 0) < 0:
        raise TemplateError("turns are streamed: a slice of them has a start only")
    return Turns(whole.stream, whole.start + (low or 0))


def _length(value: Any) -> int:
    if isinstance(value, (str, list)):
        return len(value)
    raise TemplateError(f"no length of {type(value).__name__}")


def _json(value: Any) -> str:
    if value is UNSET or isinstance(value, Turns):
        raise TemplateError("only texts, numbers, lists and members become JSON")
    return json.dumps(value, ensure_ascii=False)


def _negative(value: Any) -> int:
    if type(value) is not int:
        raise TemplateError(f"no '-' of {type(value).__name__}")
    return -value


def _method(name: str) -> Callable[..., Any]:
    def run(text: Any, *args: Any) -> Any:
        if not all(isinstance(x, str) for x in (text, *args)):
            raise TemplateError(f"{name} works on texts only")
        try:
            return getattr(str, name)(text, *args)
        except (TypeError, ValueError) as e:
            raise TemplateError(str(e)) from None

    return run


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: text_of(v).strip(), "upper": lambda v: text_of(v).upper(), "lower": lambda v: text_of(v).lower(),
    "escape": lambda v: escape(text_of(v)), "length": _length, "tojson": _json,
}
METHODS = ("strip", "lstrip", "rstrip", "upper", "lower", "startswith", "endswith", "replace", "split")
TESTS: dict[str, Callable[[Any], bool]] = {
    "none": lambda v: v is None, "string": lambda v: isinstance(v, str), "mapping": lambda v: isinstance(v, dict),
    "number": lambda v: type(v) is int, "true": lambda v: v is True, "false": lambda v: v is False,
    "defined": lambda v: v is not UNSET, "undefined": lambda v: v is UNSET,
}
#: Operations that work out all their parts first.
_EAGER: dict[str, Callable[..., Any]] = {
    "+": _alike("+", (str, int, list), lambda a, b: a + b), "-": _alike("-", (int,), lambda a, b: a - b),
    "*": _alike("*", (int,), lambda a, b: a * b), "//": _alike("//", (int,), lambda a, b: a // b),
    "%": _alike("%", (int,), lambda a, b: a % b), "~": lambda a, b: text_of(a) + text_of(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": _within,
    "<": _alike("<", (int, str), lambda a, b: a < b), "<=": _alike("<=", (int, str), lambda a, b: a <= b),
    ">": _alike(">", (int, str), lambda a, b: a > b), ">=": _alike(">=", (int, str), lambda a, b: a >= b),
    "not": lambda a: not a, "negative": _negative, "list": lambda *a: list(a), "item": _item, "slice": _slice,
    **{"|" + name: apply for name, apply in FILTERS.items()}, **{"." + name: _method(name) for name in METHODS},
    **{"is " + name: apply for name, apply in TESTS.items()},
}
_LATE = {"is defined", "is undefined", "|default"}


def fold(node: Node) -> Node:
    """The tree with constant parts worked out: expressions, branches, and neighbouring text."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind in ("set", "space", "for"):
        return (kind, node[1], *map(fold, node[2:]))
    if kind == "block":
        out: list[Node] = []
        for child in map(fold, node[1:]):
            for c in child[1:] if child[0] == "block" else (child,):
                if c[0] == "print" and c[1][0] == "const" and out and out[-1][0] == "print" and out[-1][1][0] == "const":
                    out[-1] = ("print", ("const", text_of(out[-1][1][1]) + text_of(c[1][1])))
                else:
                    out.append(c)
        return ("block", *out)
    if kind == "if":
        _, test, then, other = (kind, *map(fold, node[1:]))
        return (then if test[1] else other) if test[0] == "const" else (kind, test, then, other)
    if kind != "op":
        return (kind, *map(fold, node[1:]))
    name, parts = node[1], tuple(map(fold, node[2:]))
    first = parts[0] if parts else ("",)
    if name in ("and", "or", "choice"):
        if first[0] != "const":
            return (kind, name, *parts)
        return parts[1] if bool(first[1]) == (name != "or") else parts[2] if name == "choice" else first
    if name in _EAGER and name != "list" and name not in _LATE and all(p[0] == "const" for p in parts):
        try:
            value = _EAGER[name](*(p[1] for p in parts))
        except TemplateError:
            value = UNSET  # raises where, and if, it is worked out
        if value is not UNSET and not isinstance(value, list):
            return ("const", value)
    return (kind, name, *parts)


def _kept(node: Node) -> int:
    """How many first turns the numbers in a tree's indexes and slices may reach."""
    own = node[3][1] if node[:2] in (("op", "item"), ("op", "slice")) and node[3][0] == "const" else 0
    return max(own if type(own) is int else 0, 0) + sum(_kept(n) for n in node[1:] if isinstance(n, tuple) and n and n[0] != "const")


def _value(node: Node, strict: bool) -> Callable[[dict], Any]:
    """A closure that works out an expression in a scope of names."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]

        def named(scope: dict) -> Any:
            got = scope.get(name, UNSET)
            if strict and got is UNSET:
                raise Missing(f"nobody set {name!r}")
            return got

        return named
    parts = [_value(n, strict) for n in node[2:]]
    if kind == "space":
        names = node[1]
        return lambda scope: Namespace((n, p(scope)) for n, p in zip(names, parts))
    name = node[1]
    if name == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if name == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    if name == "choice":
        return lambda scope: parts[1](scope) if parts[0](scope) else parts[2](scope)
    if name == "raise":

        def refuse(scope: dict) -> Any:
            raise TemplateError(text_of(parts[0](scope)))

        return refuse
    if name in _LATE:

        def late(scope: dict) -> Any:
            try:
                got = parts[0](scope)
            except Missing:
                got = UNSET
            if name == "|default":
                return parts[1](scope) if got is UNSET else got
            return (got is UNSET) == (name == "is undefined")

        return late
    apply = _EAGER[name]
    if name == "item" and strict:
        whole, key = parts

        def item(scope: dict) -> Any:
            k = key(scope)
            got = _item(whole(scope), k)
            if got is UNSET:
                raise Missing(f"there is no {k!r}")
            return got

        return item
    if len(parts) == 1:
        only = parts[0]
        return lambda scope: apply(only(scope))
    if len(parts) == 2:
        left, right = parts
        return lambda scope: apply(left(scope), right(scope))
    return lambda scope: apply(*(p(scope) for p in parts))


def _render(node: Node, strict: bool) -> Callable[[dict, bool], Iterator[Piece]]:
    """A closure that yields (text, learn it) pieces."""
    kind = node[0]
    if kind == "print":
        value = _value(node[1], strict)
        return lambda scope, learn: iter(((text_of(value(scope)), learn),))
    if kind == "block":
        parts = [_render(n, strict) for n in node[1:]]

        def block(scope: dict, learn: bool) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope, learn)

        return block
    if kind == "generation":
        inner = _render(node[1], strict)
        return lambda scope, learn: inner(scope, True)
    if kind == "set":
        (name, member), value = node[1], _value(node[2], strict)

        def assign(scope: dict, learn: bool) -> Iterator[Piece]:
            if member is None:
                scope[name] = value(scope)
            elif isinstance(scope.get(name), Namespace):
                scope[name][member] = value(scope)
            else:
                raise TemplateError(f"{name!r} is no namespace")
            return iter(())

        return assign
    if kind == "if":
        test, then, other = _value(node[1], strict), _render(node[2], strict), _render(node[3], strict)
        return lambda scope, learn: (then if test(scope) else other)(scope, learn)
    name, over, body = node[1], _value(node[2], strict), _render(node[3], strict)

    def loop(scope: dict, learn: bool) -> Iterator[Piece]:
        items = over(scope)
        if isinstance(items, Turns):
            each = items.stream.loop(items.start)
        elif isinstance(items, list):
            each = zip(items, [UNSET, *items], [*items[1:], UNSET])
        else:
            raise TemplateError(f"no loop over {type(items).__name__}")
        for k, (now, before, after) in enumerate(each):
            place = {"index": k + 1, "index0": k, "first": k == 0, "last": after is UNSET, "previtem": before, "nextitem": after}
            yield from body({**scope, name: now, "loop": place}, learn)

    return loop


def compiled(
    source: str, names: Mapping[str, Any] | None = None, strict: bool = False, lines: bool = False
) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (dicts of texts) to (text, learn it) pieces.

    ``names`` are further names of the template, such as ``bos_token``;
    ``add_generation_prompt`` is false unless given. ``strict`` and ``lines`` are
    explained above and at ``parse``.
    """
    tree = fold(parse(source, lines))
    render, keep = _render(tree, strict), 1 + _kept(tree)
    return lambda messages: render({"add_generation_prompt": False, **(names or {}), "messages": Turns(Stream(messages, keep))}, False)


class Reader:
    """Reads the output of ``TEMPLATE`` back, piece by piece, and sums it up."""

    def __init__(self) -> None:
        self.turns, self.chars, self.loss = 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()
        self.text, self.held = "", ""

    def feed(self, text: str, learn: bool) -> None:
        self.chars += len(text)
        if learn:
            plain = unescape(text)
            self.loss += len(plain)
            self.learnt.update(plain.encode("utf-8", "surrogatepass"))
        self.text += text
        while (end := self.text.find(END + "\n")) >= 0:
            turn, self.text = self.text[:end], self.text[end + len(END) + 1 :]
            role, mark, said = turn.partition(MIDDLE)
            if not mark or not role.startswith(START):
                raise ValueError("the formatted text has a turn without its marks")
            self.turns += 1
            plain = f"{unescape(role[len(START):])}\n{unescape(said)}\n"
            self.all.update(plain.encode("utf-8", "surrogatepass"))

    def row(self, conv: int | None) -> tuple:
        if self.text:
            raise ValueError("the formatted text ends within a turn")
        return conv, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars


PIECES = "conv long, piece long, text string, learn boolean"
SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _formatted(template: str, names: Mapping[str, Any] | None, lines: bool):
    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, names, strict=True, lines=lines)
        rows = conversations(batches)
        ahead = next(rows, None)
        out, held = [], 0
        while ahead is not None:
            conv = ahead[0]

            def messages() -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    now, ahead = ahead, next(rows, None)
                    said = now[2] or ""
                    yield {"role": now[1] or "", "text": said, "content": said}

            source = messages()
            for k, (text, learn) in enumerate(render(source)):
                out.append((conv, k, text, learn))
                held += len(text) + 32
                if held > 1 << 20:
                    yield batch_of(out)
                    out, held = [], 0
            for _ in source:  # a template need not look at all messages
                pass
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["conv", "piece", "text", "learn"])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, conv, out = None, None, []
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in SUMMARY.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for own, text, learn in zip(*(batch.column(c).to_pylist() for c in ("conv", "text", "learn"))):
            if reader is None or own != conv:
                if reader is not None:
                    out.append(reader.row(conv))
                reader, conv = Reader(), own
            reader.feed(text, learn)
        if out:
            yield batch_of(out)
            out = []
    if reader is not None:
        yield batch_of([reader.row(conv)])


def formatted(
    turns: DataFrame, template: str = TEMPLATE, parts: int | None = None, names: Mapping[str, Any] | None = None, lines: bool = False
) -> DataFrame:
    """(conv, piece, text, learn): the output of the template, in pieces, for (conv_id, turn, role, text) rows.

    Turns are in order of turn (null last), then role, then text. Null roles and
    texts are empty; rows without conv_id are a conversation of their own.
    Repeated rows are turns like others; an empty table gives an empty one. A
    turn has the members role, text and content (the text again). The template
    is compiled here first, so that errors of its syntax are seen before a job runs;
    names and members that are missing fail the job.
    ``names`` and ``lines`` are those of ``compiled``.
    Rows of a conversation are read one after the other and never held together:
    its digest and its template need them in order, so one task streams them.
    Pieces of a conversation stay in one partition, in order.
    """
    compiled(template, names, strict=True, lines=lines)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), "turn", "role", "text")
    rows = rows.repartition(parts or width(turns), "conv").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    )
    return rows.select("conv", "role", "text").transform(in_arrow, _formatted(template, names, lines), PIECES)


def read_back(pieces: DataFrame) -> DataFrame:
    """A row for each conversation, from the pieces that ``formatted`` yields with ``TEMPLATE``; none gives none."""
    return pieces.transform(in_arrow, _read, SUMMARY)
