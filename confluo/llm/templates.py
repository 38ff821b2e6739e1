"""Compiler of a small sandboxed template language for conversations.

A template is text with ``{{ expression }}``, ``{% statement %}`` and ``{# comment #}``; a dash inside a mark (``{%-``, ``-%}``) drops the white
space of the template on that side. Statements: ``for x in list`` with ``loop`` (``index``, ``index0``, ``first``, ``last``, ``previtem``,
``nextitem``, ``length``), ``if``, ``elif``, ``else``, ``set x = expression`` and ``generation`` (what the block prints is under the loss mask).
Expressions: literals, names, ``m.key`` and ``m["key"]``, ``not and or``, comparisons, ``in``, ``+ - * // %``, ``~`` for texts, ``a if test else b``,
``is defined``, ``is none``, and the filters ``trim upper lower length default``.

The source is parsed into a syntax tree, constants are folded (known names, operators on literals, branches that are never or always
taken, texts side by side, joined texts taken apart) and the rest becomes Python closures. The sandbox is what closures can do: look up keys
of the given data, never attributes; call nothing but the filters; multiply numbers only; loop over given lists only.

Text that stands in the template is trusted. Every value of the data is escaped when it is printed: a control string in it gets the escape
character after its first character, and one that has some already gets one more, so that texts can be read back exactly.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

ESCAPE = "\\"


class TemplateError(ValueError):
    """A template that cannot be compiled, or data that it cannot print safely."""


class Undefined:
    """A name or key that is not there: empty when printed, false when tested."""

    def __bool__(self) -> bool:
        return False

    def __str__(self) -> str:
        return ""


UNDEFINED = Undefined()


class Escaper:
    """Reversible escaping of control strings.

    The first character of a control string may stand nowhere else in one, so occurrences cannot overlap.
    """

    def __init__(self, controls: Iterable[str]):
        self.controls = sorted(set(controls), key=lambda c: (-len(c), c))
        firsts = {c[:1] for c in self.controls}
        for c in self.controls:
            if len(c) < 2 or ESCAPE in c or any(x in firsts for x in c[1:]):
                raise TemplateError(f"unusable control string {c!r}")
        parts = "|".join(f"{re.escape(c[0])}%s{re.escape(c[1:])}" for c in self.controls) or r"(?!)%s"
        marks = re.escape(ESCAPE)
        self._bare = re.compile(parts.replace("%s", f"{marks}*"))
        self._stuffed = re.compile(parts.replace("%s", f"{marks}+"))
        self.control = re.compile("|".join(map(re.escape, self.controls)) or r"(?!)")
        self.reach = max(map(len, self.controls), default=1) - 1

    def escape(self, text: str) -> str:
        return self._bare.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._stuffed.sub(lambda m: m[0][0] + m[0][2:], text)


# Syntax tree ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Expr:
    """``kind`` is const, name, item, if, or an operator or filter; ``args`` are expressions, or the value of a leaf."""

    kind: str
    args: tuple[Any, ...]


@dataclass(frozen=True)
class Node:
    """``kind`` is text, print, for, if, set or generation."""

    kind: str
    value: Any = None
    body: tuple[Node, ...] = ()
    other: tuple[Node, ...] = ()


def const(value: Any) -> Expr:
    return Expr("const", (value,))


_QUOTED = r'"(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\''
_MARKS = re.compile(rf"(\{{#.*?#\}}|\{{\{{(?:{_QUOTED}|[^\"'])*?\}}\}}|\{{%(?:{_QUOTED}|[^\"'])*?%\}})", re.S)
_TOKEN = re.compile(rf"\s*(?:({_QUOTED})|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|//|[-+*%~<>()\[\].,|=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "is", "if", "else", "for", "set", "true", "false", "none", "True", "False", "None"}


def _plus(a: Any, b: Any) -> Any:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ takes two texts or two numbers")
    return a + b


def _numbers(op: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    def run(a: Any, b: Any) -> Any:
        if not isinstance(a, int) or not isinstance(b, int):
            raise TemplateError("arithmetic takes whole numbers")
        return op(a, b)

    return run


def _item(obj: Any, key: Any) -> Any:
    if isinstance(obj, Mapping):
        return obj.get(key, UNDEFINED)
    if isinstance(obj, (list, tuple)) and isinstance(key, int) and -len(obj) <= key < len(obj):
        return obj[key]
    return UNDEFINED


def _text(value: Any) -> str:
    return "" if value is None else str(value)


PURE: dict[str, Callable[..., Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "+": _plus, "-": _numbers(operator.sub), "*": _numbers(operator.mul), "//": _numbers(operator.floordiv), "%": _numbers(operator.mod),
    "~": lambda a, b: _text(a) + _text(b), "in": lambda a, b: bool(b) and a in b, "not": operator.not_,
    "item": _item, "is defined": lambda a: a is not UNDEFINED, "is none": lambda a: a is None,
    "|trim": lambda a: _text(a).strip(), "|upper": lambda a: _text(a).upper(), "|lower": lambda a: _text(a).lower(),
    "|length": lambda a: len(a) if a else 0, "|default": lambda a, b: b if a is UNDEFINED else a,
}


class _Reader:
    """Recursive descent over the tokens of one mark."""

    levels = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "//", "%"))

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"unreadable: {source.strip()!r}")
            kind = ("text", "number", "name", "sign")[found.lastindex - 1]
            self.tokens.append((kind, found[found.lastindex]))
            at = found.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> str | None:
        kind, value = self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", None)
        return None if kind == "text" else value

    def take(self, *allowed: str) -> bool:
        if self.peek() in allowed:
            self.at += 1
            return True
        return False

    def need(self, what: str) -> None:
        if not self.take(what):
            raise TemplateError(f"{what!r} is missing in {self.source.strip()!r}")

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        if kind != "name" or value in _WORDS:
            raise TemplateError(f"a name is missing in {self.source.strip()!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unreadable: {self.source.strip()!r}")

    def expression(self) -> Expr:
        value = self._level(0)
        if self.take("if"):
            test = self._level(0)
            other = self.expression() if self.take("else") else const("")
            return Expr("if", (test, value, other))
        return value

    def _level(self, n: int) -> Expr:
        if n == len(self.levels):
            return self._postfix()
        signs = self.levels[n]
        if signs == ("not",):
            return Expr("not", (self._level(n),)) if self.take("not") else self._level(n + 1)
        left = self._level(n + 1)
        while True:
            sign = self.peek()
            if "in" in signs and sign == "not" and self.peek(1) == "in":
                self.at += 2
                left = Expr("not", (Expr("in", (left, self._level(n + 1))),))
            elif "in" in signs and self.take("is"):
                denied, test = self.take("not"), self.tokens[self.at][1] if self.at < len(self.tokens) else None
                if test not in ("defined", "none"):
                    raise TemplateError(f"unknown test in {self.source.strip()!r}")
                self.at += 1
                left = Expr(f"is {test}", (left,))
                left = Expr("not", (left,)) if denied else left
            elif sign in signs:
                self.at += 1
                left = Expr(sign, (left, self._level(n + 1)))
            else:
                return left

    def _postfix(self) -> Expr:
        value = self._atom()
        while True:
            if self.take("."):
                value = Expr("item", (value, const(self.name())))
            elif self.take("["):
                value = Expr("item", (value, self.expression()))
                self.need("]")
            elif self.take("|"):
                filter_, args = "|" + self.name(), [value]
                if self.take("("):
                    args.append(self.expression())
                    self.need(")")
                if filter_ not in PURE or len(args) != 1 + (filter_ == "|default"):
                    raise TemplateError(f"unknown filter in {self.source.strip()!r}")
                value = Expr(filter_, tuple(args))
            else:
                return value

    def _atom(self) -> Expr:
        if self.take("("):
            value = self.expression()
            self.need(")")
            return value
        if self.take("-"):
            return Expr("-", (const(0), self._postfix()))
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        if kind == "text":
            self.at += 1
            return const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            self.at += 1
            return const(int(value))
        for words, known in ((("true", "True"), True), (("false", "False"), False), (("none", "None"), None)):
            if self.take(*words):
                return const(known)
        return Expr("name", (self.name(),))


def _marks(source: str) -> list[tuple[str, str]]:
    """``(kind, inside)`` of the texts and marks in order, white space dropped where a dash says so."""
    pieces = _MARKS.split(source)
    out = []
    for i, piece in enumerate(pieces):
        if i % 2:
            if piece[1] != "#":
                out.append((piece[1], piece[2:-2].removeprefix("-").removesuffix("-")))
            continue
        if i and pieces[i - 1][-3] == "-":
            piece = piece.lstrip()
        if i + 1 < len(pieces) and pieces[i + 1][2] == "-":
            piece = piece.rstrip()
        if re.search(r"\{\{|\{%|\{#", piece):
            raise TemplateError(f"a mark is not closed: {piece!r}")
        out.append(("text", piece))
    return out


def parse(source: str) -> tuple[Node, ...]:
    """The syntax tree of a template."""
    marks, at = _marks(source), 0

    def block(stops: tuple[str, ...]) -> tuple[tuple[Node, ...], str]:
        nonlocal at
        nodes: list[Node] = []
        while at < len(marks):
            kind, inside = marks[at]
            at += 1
            if kind == "text":
                nodes.append(Node("text", inside))
                continue
            reader = _Reader(inside)
            if kind == "{":
                nodes.append(Node("print", reader.expression()))
                reader.end()
                continue
            word = reader.peek()
            if word in stops:
                return tuple(nodes), inside
            reader.at += 1
            if word == "for":
                name = reader.name()
                reader.need("in")
                items = reader.expression()
                body, stop = block(("endfor", "else"))
                other, _ = block(("endfor",)) if stop.strip() == "else" else ((), "")
                nodes.append(Node("for", (name, items), body, other))
            elif word == "if":
                nodes.append(branch(reader.expression()))
            elif word == "set":
                name = reader.name()
                reader.need("=")
                nodes.append(Node("set", (name, reader.expression())))
            elif word == "generation":
                nodes.append(Node("generation", None, block(("endgeneration",))[0]))
            else:
                raise TemplateError(f"unknown statement: {inside.strip()!r}")
            reader.end()
        if stops:
            raise TemplateError(f"{' or '.join(stops)} is missing")
        return tuple(nodes), ""

    def branch(test: Expr) -> Node:
        body, stop = block(("elif", "else", "endif"))
        reader = _Reader(stop)
        if reader.take("elif"):
            other: tuple[Node, ...] = (branch(reader.expression()),)
        elif reader.take("else"):
            other = block(("endif",))[0]
        else:
            other = ()
        return Node("if", test, body, other)

    return block(())[0]


# Folding --------------------------------------------------------------------------------------------------------------


def fold_expr(expr: Expr, known: Mapping[str, Any]) -> Expr:
    if expr.kind == "const":
        return expr
    if expr.kind == "name":
        return const(known[expr.args[0]]) if expr.args[0] in known else expr
    args = tuple(fold_expr(a, known) for a in expr.args)
    first = args[0]
    if expr.kind == "if" and first.kind == "const":
        return args[1] if first.args[0] else args[2]
    if expr.kind in ("and", "or") and first.kind == "const":
        return args[1] if bool(first.args[0]) == (expr.kind == "and") else first
    if expr.kind in PURE and all(a.kind == "const" for a in args):
        try:
            return const(PURE[expr.kind](*[a.args[0] for a in args]))
        except (TemplateError, TypeError, ZeroDivisionError):
            pass  # fails when it runs, if it ever does
    return Expr(expr.kind, args)


def _printed(expr: Expr) -> list[Node]:
    """A printed expression as texts and values: what the template itself says stays trusted."""
    if expr.kind == "const":
        text = _text(expr.args[0])
        return [Node("text", text)] if text else []
    text_side = any(a.kind == "const" and isinstance(a.args[0], str) for a in expr.args if isinstance(a, Expr))
    if expr.kind == "~" or (expr.kind == "+" and text_side):
        return [n for a in expr.args for n in _printed(a)]
    if expr.kind == "if":
        test, yes, no = expr.args
        return [Node("if", test, tuple(_printed(yes)), tuple(_printed(no)))]
    return [Node("print", expr)]


def fold(nodes: tuple[Node, ...], known: Mapping[str, Any]) -> tuple[Node, ...]:
    out: list[Node] = []
    known = dict(known)
    for node in nodes:
        if node.kind == "print":
            new = _printed(fold_expr(node.value, known))
        elif node.kind == "if":
            test = fold_expr(node.value, known)
            body, other = fold(node.body, known), fold(node.other, known)
            new = list(body if test.args[0] else other) if test.kind == "const" else [Node("if", test, body, other)]
            # A name set in a branch is not known after it.
            for name in _set_names(node.body) | _set_names(node.other):
                known.pop(name, None)
        elif node.kind == "for":
            name, items = node.value[0], fold_expr(node.value[1], known)
            inside = {k: v for k, v in known.items() if k not in {name, "loop"} | _set_names(node.body)}
            empty = items.kind == "const" and not items.args[0]
            new = list(fold(node.other, known)) if empty else [Node("for", (name, items), fold(node.body, inside), fold(node.other, known))]
        elif node.kind == "set":
            name, value = node.value[0], fold_expr(node.value[1], known)
            known.pop(name, None)
            if value.kind == "const":
                known[name] = value.args[0]
            new = [Node("set", (name, value))]
        elif node.kind == "generation":
            new = [Node("generation", None, fold(node.body, known))]
        else:
            new = [node]
        for n in new:
            if n.kind == "text" and out and out[-1].kind == "text":
                out[-1] = Node("text", out[-1].value + n.value)
            elif n.kind != "text" or n.value:
                out.append(n)
    return tuple(out)


def _set_names(nodes: tuple[Node, ...]) -> set[str]:
    names = {n.value[0] for n in nodes if n.kind == "set"}
    # A loop keeps what it sets to itself.
    return names.union(*[_set_names(n.body) | _set_names(n.other) for n in nodes if n.kind in ("if", "generation")])


def _uses(part: Any, test: Callable[[Expr], bool]) -> bool:
    if isinstance(part, Expr):
        return test(part) or any(_uses(a, test) for a in part.args)
    if isinstance(part, Node):
        return _uses(part.value, test) or _uses(part.body, test) or _uses(part.other, test)
    return isinstance(part, tuple) and any(_uses(p, test) for p in part)


# Closures -------------------------------------------------------------------------------------------------------------

Env = dict[str, Any]


@dataclass
class Sink:
    """Printed text with the code points under the loss mask; ``start`` is the length of what was taken away already."""

    escaper: Escaper
    parts: list[str] = field(default_factory=list)
    start: int = 0
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    tail: str = ""

    def literal(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)
        self.tail = ""

    def value(self, value: Any) -> None:
        text = self.escaper.escape(_text(value))
        if self.tail and text:
            # Two values side by side must not form a control string that neither holds.
            seam = self.tail + text[: self.escaper.reach]
            if any(m.start() < len(self.tail) < m.end() for m in self.escaper.control.finditer(seam)):
                raise TemplateError("two values side by side form a control string; put text between them")
        self.parts.append(text)
        self.size += len(text)
        self.tail = (self.tail + text)[-self.escaper.reach :]

    def take(self) -> tuple[int, str, list[tuple[int, int]]]:
        """Start, text and spans since the last call."""
        out = self.start, "".join(self.parts), self.spans
        self.start, self.parts, self.spans, self.size = self.start + self.size, [], [], 0
        return out


def compile_expr(expr: Expr) -> Callable[[Env], Any]:
    if expr.kind == "const":
        value = expr.args[0]
        return lambda env: value
    if expr.kind == "name":
        name = expr.args[0]
        return lambda env: env.get(name, UNDEFINED)
    args = [compile_expr(a) for a in expr.args]
    if expr.kind == "if":
        test, yes, no = args
        return lambda env: yes(env) if test(env) else no(env)
    if expr.kind == "and":
        a, b = args
        return lambda env: a(env) and b(env)
    if expr.kind == "or":
        a, b = args
        return lambda env: a(env) or b(env)
    run = PURE[expr.kind]
    if len(args) == 1:
        (one,) = args
        return lambda env: run(one(env))
    left, right = args
    return lambda env: run(left(env), right(env))


Step = Callable[[Env, Sink], None]


def _looped(items: Iterable[Any], length: int | None) -> Iterator[tuple[Any, Env]]:
    """Items with their ``loop`` fields, looking one item ahead."""
    rows, before, index = iter(items), UNDEFINED, 0
    item = next(rows, rows)
    while item is not rows:
        after = next(rows, rows)
        last = after is rows
        loop = {"index": index + 1, "index0": index, "first": not index, "last": last, "previtem": before}
        loop["nextitem"] = UNDEFINED if last else after
        if length is not None:
            loop["length"] = length
        yield item, loop
        before, item, index = item, after, index + 1


def _compile_for(node: Node) -> Callable[[Env, Sink, Iterable[Any] | None], Iterator[None]]:
    """A loop as a generator that stops after every item."""
    name, items, body, other = node.value[0], compile_expr(node.value[1]), compile_nodes(node.body), compile_nodes(node.other)

    def run(env: Env, sink: Sink, stream: Iterable[Any] | None = None) -> Iterator[None]:
        rows = items(env) if stream is None else stream
        if stream is None and not isinstance(rows, (list, tuple)):
            rows = []
        empty = True
        for item, loop in _looped(rows, None if stream is not None else len(rows)):
            empty = False
            body({**env, name: item, "loop": loop}, sink)
            yield
        if empty:
            other(env, sink)

    return run


def compile_nodes(nodes: tuple[Node, ...]) -> Step:
    steps: list[Step] = []
    for node in nodes:
        if node.kind == "text":
            steps.append(lambda env, sink, text=node.value: sink.literal(text))
        elif node.kind == "print":
            steps.append(lambda env, sink, value=compile_expr(node.value): sink.value(value(env)))
        elif node.kind == "set":
            steps.append(lambda env, sink, name=node.value[0], value=compile_expr(node.value[1]): env.__setitem__(name, value(env)))
        elif node.kind == "if":
            test, body, other = compile_expr(node.value), compile_nodes(node.body), compile_nodes(node.other)
            steps.append(lambda env, sink, t=test, b=body, o=other: b(env, sink) if t(env) else o(env, sink))
        elif node.kind == "for":
            steps.append(lambda env, sink, loop=_compile_for(node): [None for _ in loop(env, sink)] and None)
        else:

            def generation(env: Env, sink: Sink, body: Step = compile_nodes(node.body)) -> None:
                begin = sink.start + sink.size
                body(env, sink)
                sink.spans.append((begin, sink.start + sink.size))

            steps.append(generation)

    def run(env: Env, sink: Sink) -> None:
        for step in steps:
            step(env, sink)

    return run


def _is_messages(expr: Expr) -> bool:
    return expr.kind == "name" and expr.args[0] == "messages"


class Template:
    """A compiled template. ``controls`` are the strings that texts must not be able to say; ``known`` are constant names."""

    def __init__(self, source: str, controls: Iterable[str], known: Mapping[str, Any] | None = None):
        self.escaper = Escaper(controls)
        self.tree = fold(parse(source), known or {})
        self._check_texts(self.tree)
        over = [n for n in self.tree if n.kind == "for" and _is_messages(n.value[1])]
        rest = [n for n in self.tree if n not in over]
        loops = [part for n in over for part in (*n.body, *n.other)]
        is_length = lambda e: e.kind == "item" and e.args[0] == Expr("name", ("loop",)) and e.args[1] == const("length")
        #: True if messages are only looked at one after the other, so that a conversation of any length needs little memory.
        self.streams = len(over) == 1 and not _uses((*rest, *loops), _is_messages) and not _uses(tuple(loops), is_length)
        self.steps = [(_compile_for(n) if n in over else None, compile_nodes((n,))) for n in self.tree]

    def _check_texts(self, nodes: tuple[Node, ...]) -> None:
        """No text of the template may end with the start, or start with the end, of a control string: a value could complete it."""
        for node in nodes:
            if node.kind == "text":
                for c in self.escaper.controls:
                    edge = any(node.value.endswith(c[:i]) or node.value.startswith(c[-i:]) for i in range(1, len(c)))
                    if edge or node.value in c[1:-1]:
                        raise TemplateError(f"a value beside the template text {node.value!r} could complete {c!r}")
            self._check_texts(node.body)
            self._check_texts(node.other)

    def pieces(self, messages: Iterable[Mapping[str, Any]], room: int = 1 << 22, **names: Any) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
        """``(start, text, spans)`` of the printed conversation, cut between messages once ``room`` code points are there.

        A template that needs all messages at once gets them as a list.
        """
        sink = Sink(self.escaper)
        env: Env = dict(names)
        if not self.streams:
            messages = env["messages"] = list(messages)
        for loop, step in self.steps:
            if loop is None:
                step(env, sink)
            else:
                for _ in loop(env, sink, messages if self.streams else None):
                    if sink.size >= room:
                        yield sink.take()
        yield sink.take()

    def render(self, messages: Iterable[Mapping[str, Any]], **names: Any) -> tuple[str, list[tuple[int, int]]]:
        """The printed conversation and the code points ``(start, end)`` under the loss mask."""
        found = list(self.pieces(messages, **names))
        return "".join(text for _, text, _ in found), [s for _, _, spans in found for s in spans]
