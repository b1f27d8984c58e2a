"""A small template language for conversations, compiled to Python closures.

``{{ value }}`` writes a value, ``{% for x in list %}``, ``{% if %} {% elif %} {% else %}``, ``{% set name = value %}`` and
``{% generation %}`` (what a model is to learn) hold blocks, ``{# remark #}`` is dropped; a ``-`` inside a tag takes the white
space beside it. Values: strings, integers, true, false, none, names, ``x.key``, ``x[key]``, ``x | filter(arguments)``,
``~ + -``, comparisons, ``in``, ``and or not``, ``a if b else c``.

The language is a sandbox: a template sees the variables it is given and the entries of dictionaries and lists, never
attributes or methods of objects; filters are a fixed set; nothing repeats but ``for`` over what is given, so the output is
bounded by the template and its input.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from enum import Enum
from typing import Any, NamedTuple


class TemplateError(ValueError):
    pass


class Mark(Enum):
    """Begin or end of what is to be learned, in the stream of written text."""

    BEGIN = "begin"
    END = "end"


BEGIN, END = Mark
Expression = Callable[[dict], Any]
Statement = Callable[[dict], Iterator["str | Mark"]]

# --- syntax tree ---------------------------------------------------------------------------------------------


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Item(NamedTuple):
    of: Any
    key: Any


class Filter(NamedTuple):
    name: str
    args: tuple


class Unary(NamedTuple):
    op: str
    value: Any


class Binary(NamedTuple):
    op: str
    left: Any
    right: Any


class Choice(NamedTuple):
    test: Any
    yes: Any
    no: Any


class Text(NamedTuple):
    text: str


class Write(NamedTuple):
    value: Any


class For(NamedTuple):
    name: str
    of: Any
    body: tuple


class If(NamedTuple):
    test: Any
    yes: tuple
    no: tuple


class Set(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: tuple


TAG = re.compile(r"\{\{-?(?P<write>.*?)-?\}\}|\{%-?(?P<tag>.*?)-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<int>\d+)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>.,|()\[\]=]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t"}
WORDS = {"true": True, "false": False, "none": None}
KEYWORDS = {*WORDS, "and", "or", "not", "in", "if", "else", "elif", "for", "set", "generation", "loop"}


class Tokens:
    def __init__(self, source: str):
        self.items: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.items.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.items[self.at] if self.at < len(self.items) else ("end", "")

    def take(self, *wanted: str) -> str | None:
        """The next token if it is one of these signs or words."""
        kind, value = self.peek()
        if kind in ("sign", "name") and value in wanted:
            self.at += 1
            return value
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} wanted, {self.peek()[1]!r} found")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name" or value in KEYWORDS or value.startswith("_"):
            raise TemplateError(f"not a name that may be used: {value!r}")
        self.at += 1
        return value

    def done(self) -> None:
        if self.at < len(self.items):
            raise TemplateError(f"{self.peek()[1]!r} is too much")


def read_value(t: Tokens):
    value = read_or(t)
    if t.take("if"):
        test = read_or(t)
        t.need("else")
        return Choice(test, value, read_value(t))
    return value


def read_or(t: Tokens):
    value = read_and(t)
    while t.take("or"):
        value = Binary("or", value, read_and(t))
    return value


def read_and(t: Tokens):
    value = read_not(t)
    while t.take("and"):
        value = Binary("and", value, read_not(t))
    return value


def read_not(t: Tokens):
    if t.take("not"):
        return Unary("not", read_not(t))
    value = read_sum(t)
    while op := t.take("==", "!=", "<", "<=", ">", ">=", "in"):
        value = Binary(op, value, read_sum(t))
    if t.take("not"):
        t.need("in")
        value = Unary("not", Binary("in", value, read_sum(t)))
    return value


def read_sum(t: Tokens):
    value = read_item(t)
    while op := t.take("+", "-", "~"):
        value = Binary(op, value, read_item(t))
    return value


def read_item(t: Tokens):
    value = read_one(t)
    while True:
        if t.take("."):
            kind, key = t.peek()
            if kind != "name" or key.startswith("_"):
                raise TemplateError(f"not an entry that may be used: {key!r}")
            t.at += 1
            value = Item(value, Const(key))
        elif t.take("["):
            value = Item(value, read_value(t))
            t.need("]")
        elif t.take("|"):
            name, args = t.name(), [value]
            if t.take("("):
                while not t.take(")"):
                    args.append(read_value(t))
                    if not t.take(","):
                        t.need(")")
                        break
            value = Filter(name, tuple(args))
        else:
            return value


def read_one(t: Tokens):
    kind, value = t.peek()
    if t.take("("):
        inner = read_value(t)
        t.need(")")
        return inner
    if t.take("-"):
        return Unary("-", read_item(t))
    if kind == "int":
        t.at += 1
        return Const(int(value))
    if kind == "str":
        t.at += 1
        return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
    if kind == "name" and value in WORDS:
        t.at += 1
        return Const(WORDS[value])
    if t.take("loop"):
        return Name("loop")
    return Name(t.name())


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at, trim = 0, False
    for m in TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if m[0][2] == "-" else text))
        if m["write"] is not None or m["tag"] is not None:
            parts.append(("write", m["write"]) if m["write"] is not None else ("tag", m["tag"].strip()))
        at, trim = m.end(), m[0][-3] == "-"
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    tree, end = read_block(parts, 0, ())
    return tree


def read_block(parts: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    """Statements up to one of the tags ``ends``, and the place of that tag."""
    out = []
    while at < len(parts):
        kind, source = parts[at]
        if kind == "text":
            if source:
                out.append(Text(source))
            at += 1
            continue
        if kind == "write":
            t = Tokens(source)
            out.append(Write(read_value(t)))
            t.done()
            at += 1
            continue
        word = source.split(None, 1)[0] if source else ""
        if word in ends:
            return tuple(out), at
        t = Tokens(source)
        if t.take("for"):
            name = t.name()
            t.need("in")
            of = read_value(t)
            t.done()
            body, at = read_block(parts, at + 1, ("endfor",))
            out.append(For(name, of, body))
        elif t.take("if"):
            statement, at = read_if(t, parts, at)
            out.append(statement)
        elif t.take("set"):
            name = t.name()
            t.need("=")
            out.append(Set(name, read_value(t)))
            t.done()
        elif t.take("generation"):
            t.done()
            body, at = read_block(parts, at + 1, ("endgeneration",))
            out.append(Generation(body))
        else:
            raise TemplateError(f"no such tag: {source!r}")
        at += 1
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(out), at


def read_if(t: Tokens, parts, at: int) -> tuple[If, int]:
    test = read_value(t)
    t.done()
    yes, at = read_block(parts, at + 1, ("elif", "else", "endif"))
    t = Tokens(parts[at][1])
    if t.take("elif"):
        inner, at = read_if(t, parts, at)
        return If(test, yes, (inner,)), at
    no: tuple = ()
    if t.take("else"):
        t.done()
        no, at = read_block(parts, at + 1, ("endif",))
    return If(test, yes, no), at


# --- constants -----------------------------------------------------------------------------------------------

BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "~": lambda a, b: shown(a) + shown(b), "+": lambda a, b: a + b, "-": lambda a, b: a - b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}


def shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def fold(node, filters: dict[str, Callable]):
    """The same tree with everything worked out that doesn't depend on variables; neighbouring texts are joined."""
    if isinstance(node, tuple) and type(node) is tuple:
        out: list = []
        for child in node:
            child = fold(child, filters)
            for c in child if type(child) is tuple else (child,):
                if isinstance(c, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + c.text)
                elif not (isinstance(c, Text) and not c.text):
                    out.append(c)
        return tuple(out)
    if isinstance(node, Item):
        of, key = fold(node.of, filters), fold(node.key, filters)
        return Item(of, key)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"no such filter: {node.name}")
        args = tuple(fold(a, filters) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(filters[node.name](*(a.value for a in args)))
        return Filter(node.name, args)
    if isinstance(node, Unary):
        value = fold(node.value, filters)
        if isinstance(value, Const):
            return Const(not value.value if node.op == "not" else -value.value)
        return Unary(node.op, value)
    if isinstance(node, Binary):
        left, right = fold(node.left, filters), fold(node.right, filters)
        if node.op in ("and", "or"):
            if isinstance(left, Const):
                return right if bool(left.value) == (node.op == "and") else left
        elif isinstance(left, Const) and isinstance(right, Const):
            return Const(BINARY[node.op](left.value, right.value))
        return Binary(node.op, left, right)
    if isinstance(node, Choice):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, filters)
        return Choice(test, fold(node.yes, filters), fold(node.no, filters))
    if isinstance(node, Write):
        value = fold(node.value, filters)
        return Text(shown(value.value)) if isinstance(value, Const) else Write(value)
    if isinstance(node, For):
        return For(node.name, fold(node.of, filters), fold(node.body, filters))
    if isinstance(node, If):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, filters)
        return If(test, fold(node.yes, filters), fold(node.no, filters))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    return node


# --- closures ------------------------------------------------------------------------------------------------


def entry_of(of: Any, key: Any) -> Any:
    """An entry of a dictionary or list; none where there is no such entry. Nothing else can be looked into."""
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, str)) and isinstance(key, int) and -len(of) <= key < len(of):
        return of[key]
    return None


def value_of(node, filters: dict[str, Callable]) -> Expression:
    """Closure that works out an expression over the variables."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Item):
        of, key = value_of(node.of, filters), value_of(node.key, filters)
        if isinstance(node.key, Const):
            fixed = node.key.value
            return lambda scope: entry_of(of(scope), fixed)
        return lambda scope: entry_of(of(scope), key(scope))
    if isinstance(node, Filter):
        fn, args = filters[node.name], [value_of(a, filters) for a in node.args]
        if len(args) == 1:
            only = args[0]
            return lambda scope: fn(only(scope))
        return lambda scope: fn(*[a(scope) for a in args])
    if isinstance(node, Unary):
        value = value_of(node.value, filters)
        return (lambda scope: not value(scope)) if node.op == "not" else (lambda scope: -value(scope))
    if isinstance(node, Binary):
        left, right = value_of(node.left, filters), value_of(node.right, filters)
        if node.op == "and":
            return lambda scope: left(scope) and right(scope)
        if node.op == "or":
            return lambda scope: left(scope) or right(scope)
        fn = BINARY[node.op]
        return lambda scope: fn(left(scope), right(scope))
    test, yes, no = (value_of(n, filters) for n in node)
    return lambda scope: yes(scope) if test(scope) else no(scope)


def writer_of(nodes: tuple, filters: dict[str, Callable], learned: bool = False) -> Statement:
    """Closure that writes a block as a stream of texts and marks; nothing of a ``for`` is held but one element."""
    steps = [step_of(n, filters, learned) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def block(scope):
        for step in steps:
            yield from step(scope)

    return block


def step_of(node, filters: dict[str, Callable], learned: bool) -> Statement:
    if isinstance(node, Text):
        one = (node.text,)
        return lambda scope: one
    if isinstance(node, Write):
        value = value_of(node.value, filters)
        return lambda scope: (shown(value(scope)),)
    if isinstance(node, Set):
        name, value = node.name, value_of(node.value, filters)

        def assign(scope):
            scope[name] = value(scope)
            return ()

        return assign
    if isinstance(node, If):
        test, yes, no = value_of(node.test, filters), writer_of(node.yes, filters, learned), writer_of(node.no, filters, learned)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, Generation):
        if learned:
            raise TemplateError("generation inside generation")
        body = writer_of(node.body, filters, True)

        def marked(scope):
            yield BEGIN
            yield from body(scope)
            yield END

        return marked
    name, of, body = node.name, value_of(node.of, filters), writer_of(node.body, filters, learned)

    def each(scope):
        given = of(scope)
        inner, missing = dict(scope), object()
        items = iter(() if given is None else given)
        item, index = next(items, missing), 0
        while item is not missing:
            following = next(items, missing)
            inner[name] = item
            inner["loop"] = {"index": index + 1, "index0": index, "first": index == 0, "last": following is missing}
            yield from body(inner)
            item, index = following, index + 1

    return each


def uses(node, name: str) -> int:
    """How often a tree refers to a variable."""
    if isinstance(node, Name):
        return int(node.name == name)
    return sum(uses(child, name) for child in node if isinstance(child, tuple)) if isinstance(node, tuple) else 0


class Controls:
    """Strings that only the template may write, and the escape that keeps them out of texts.

    A backslash is doubled, and a control string gets one after its first character. Control strings are of two characters or
    more, hold no backslash and don't end as they begin, so a string that is found is one that the template wrote.
    """

    def __init__(self, *strings: str):
        for s in strings:
            if len(s) < 2 or "\\" in s or any(s.startswith(s[-n:]) for n in range(1, len(s))):
                raise TemplateError(f"{s!r} can't be a control string")
        self.strings = strings
        self.pattern = re.compile("|".join([r"\\", *(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings)]))

    def escape(self, text: Any) -> str:
        return self.pattern.sub(lambda m: m[0] + "\\", shown(text))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


class Template:
    """A compiled template over ``messages``.

    ``pieces`` gives the texts and marks as they are written. Where ``messages`` is used once, by a loop of its own, messages
    are taken from their iterator one by one; else they are held as a list.
    """

    def __init__(self, source: str, controls: Controls):
        self.controls = controls
        self.filters: dict[str, Callable] = {
            "escape": controls.escape, "trim": lambda x: shown(x).strip(), "upper": lambda x: shown(x).upper(), "lower": lambda x: shown(x).lower(),
            "capitalize": lambda x: shown(x).capitalize(), "default": lambda x, other="": other if x is None else x,
            "length": lambda x: 0 if x is None else len(x), "join": lambda x, by="": shown(by).join(map(shown, x or ()))}
        self.tree = fold(parse(source), self.filters)
        self.write = writer_of(self.tree, self.filters)
        self.streams = uses(self.tree, "messages") == 1 and any(isinstance(n, For) and n.of == Name("messages") for n in self.tree)

    def pieces(self, messages: Iterable[dict], **variables: Any) -> Iterator[str | Mark]:
        return iter(self.write({**variables, "messages": messages if self.streams else list(messages)}))

    def render(self, messages: Iterable[dict], **variables: Any) -> tuple[str, list[tuple[int, int]]]:
        """The whole text, and the spans to be learned in code points."""
        out, spans, at = [], [], 0
        for piece in self.pieces(messages, **variables):
            if piece is BEGIN:
                spans.append((at, at))
            elif piece is END:
                spans[-1] = (spans[-1][0], at)
            else:
                out.append(piece)
                at += len(piece)
        return "".join(out), spans
