"""A small sandboxed template language for conversations, compiled to Python closures.

Text stands for itself; ``{{ expression }}`` writes a value; the statements are ``{% for name in expression %}``, ``{% if %}``,
``{% elif %}``, ``{% else %}``, ``{% set name = expression %}`` and ``{% generation %}``, which marks what a model is
trained to write. A ``-`` inside the braces strips white space on that side. Expressions have literals, names, ``a.b`` and ``a['b']``, ``not``,
``and``, ``or``, comparisons, ``in``, ``+``, ``a if b else c`` and the filters below. There are no calls, and only entries of
mappings can be reached, so a template can touch nothing but its input.

A template is parsed into a tree, constant parts of the tree are folded, and each node becomes one closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from operator import add, eq, ge, gt, le, lt, ne

# Strings that steer common chat formats. A backslash behind the first character takes the meaning away.
_CONTROL = r"/?s>|/?INST\]|\|"
_ESCAPE = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_CONTROL})")


def escape(text: str) -> str:
    """No control string is left; :func:`unescape` gives the text back whatever it held."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


class TemplateError(ValueError):
    pass


FILTERS: dict[str, Callable] = {
    "escape": lambda value: escape(_shown(value)), "trim": lambda value: _shown(value).strip(),
    "upper": lambda value: _shown(value).upper(), "lower": lambda value: _shown(value).lower(),
    "length": lambda value: len(value or ""),
}
_COMPARE = {"==": eq, "!=": ne, "<": lt, "<=": le, ">": gt, ">=": ge}
_TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z]\w*)|(?P<mark>==|!=|<=|>=|[-+.|()\[\]<>=]))""")
_PART = re.compile(r"(\{\{-?|\{%-?)((?:'[^']*'|\"[^\"]*\"|.)*?)(-?\}\}|-?%\})", re.S)


def _shown(value) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


class _Expression:
    """Parser of one expression; nodes are tuples whose first entry names them."""

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        while at < len(source.rstrip()):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def parse(self):
        tree = self.conditional()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return tree

    def word(self, *words: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in words:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, word: str) -> None:
        if not self.word(word):
            raise TemplateError(f"{word!r} is missing in {self.source!r}")

    def conditional(self):
        value = self.either()
        if self.word("if"):
            test = self.either()
            self.need("else")
            return ("choose", test, value, self.conditional())
        return value

    def either(self):
        left = self.both()
        while self.word("or"):
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.word("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.word("not") else self.compared()

    def compared(self):
        left = self.sum()
        if sign := self.word(*_COMPARE):
            return ("compare", sign, left, self.sum())
        if self.word("in"):
            return ("in", left, self.sum())
        return left

    def sum(self):
        left = self.filtered()
        while self.word("+"):
            left = ("add", left, self.filtered())
        return left

    def filtered(self):
        value = self.reached()
        while self.word("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = ("filter", name, value)
        return value

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"a name is missing in {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def reached(self):
        value = self.single()
        while True:
            if self.word("."):
                value = ("entry", value, ("constant", self.name()))
            elif self.word("["):
                value = ("entry", value, self.conditional())
                self.need("]")
            else:
                return value

    def single(self):
        if self.word("("):
            value = self.conditional()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError(f"a value is missing in {self.source!r}")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return ("constant", int(text))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            return ("constant", known[text]) if text in known else ("name", text)
        raise TemplateError(f"unexpected {text!r} in {self.source!r}")


def _parts(source: str):
    """('text', text), ('write', expression) and ('do', words) in order."""
    at, strip = 0, False
    for found in _PART.finditer(source):
        text = source[at : found.start()]
        text = text.lstrip() if strip else text
        yield "text", text.rstrip() if found[1].endswith("-") else text
        yield ("write" if found[1].startswith("{{") else "do"), found[2].strip()
        at, strip = found.end(), found[3].startswith("-")
    yield "text", source[at:].lstrip() if strip else source[at:]


class _Statements:
    def __init__(self, source: str):
        self.parts = list(_parts(source))
        self.at = 0

    def block(self, *ends: str):
        """Nodes up to one of ``ends``, and the statement that ended them."""
        nodes = []
        while self.at < len(self.parts):
            kind, text = self.parts[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(("write", ("constant", text)))
            elif kind == "write":
                nodes.append(("write", _Expression(text).parse()))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return ("block", nodes), (word, rest)
                nodes.append(self.statement(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return ("block", nodes), ("", "")

    def statement(self, word: str, rest: str):
        if word == "for":
            name, _, source = rest.partition(" in ")
            if not re.fullmatch(r"[A-Za-z]\w*", name.strip()) or not source:
                raise TemplateError(f"cannot read for {rest!r}")
            body, _ = self.block("endfor")
            return ("for", name.strip(), _Expression(source).parse(), body)
        if word == "if":
            body, (ended, more) = self.block("elif", "else", "endif")
            other = ("block", [])
            if ended == "elif":
                other = self.statement("if", more)
            elif ended == "else":
                other, _ = self.block("endif")
            return ("if", _Expression(rest).parse(), body, other)
        if word == "generation":
            body, _ = self.block("endgeneration")
            return ("generation", body)
        if word == "set":
            name, _, source = rest.partition("=")
            if not re.fullmatch(r"[A-Za-z]\w*", name.strip()):
                raise TemplateError(f"cannot read set {rest!r}")
            return ("set", name.strip(), _Expression(source).parse())
        raise TemplateError(f"unknown statement {word!r}")


def _is_constant(node) -> bool:
    return isinstance(node, tuple) and node[0] == "constant"


def fold(node):
    """The tree with all that does not depend on the input computed, neighbouring texts joined and dead branches gone."""
    kind = node[0]
    if kind in ("constant", "name"):
        return node
    if kind == "block":
        nodes = []
        for inner in map(fold, node[1]):
            for each in inner[1] if inner[0] == "block" else [inner]:
                if each[0] == "write" and _is_constant(each[1]):
                    text = _shown(each[1][1])
                    if nodes and nodes[-1][0] == "write" and _is_constant(nodes[-1][1]):
                        nodes[-1] = ("write", ("constant", nodes[-1][1][1] + text))
                        continue
                    each = ("write", ("constant", text))
                    if not text:
                        continue
                nodes.append(each)
        return ("block", nodes)
    node = tuple(fold(part) if isinstance(part, tuple) else part for part in node)
    if kind in ("if", "choose") and _is_constant(node[1]):
        return node[2] if node[1][1] else node[3]
    if kind in ("and", "or") and _is_constant(node[1]):
        return node[2] if bool(node[1][1]) == (kind == "and") else node[1]
    if kind in ("add", "compare", "in", "not", "filter") and all(_is_constant(p) for p in node[1:] if isinstance(p, tuple)):
        return ("constant", _value(node)({}))
    return node


def _value(node) -> Callable[[dict], object]:
    """The closure of an expression."""
    kind = node[0]
    if kind == "constant":
        return lambda env, value=node[1]: value
    if kind == "name":
        return lambda env, name=node[1]: env.get(name)
    if kind == "filter":
        function, inner = FILTERS[node[1]], _value(node[2])
        return lambda env: function(inner(env))
    if kind == "compare":
        compare, left, right = _COMPARE[node[1]], _value(node[2]), _value(node[3])
        return lambda env: compare(left(env), right(env))
    parts = [_value(part) for part in node[1:]]
    if kind == "not":
        return lambda env, inner=parts[0]: not inner(env)
    if kind == "choose":
        test, yes, no = parts
        return lambda env: yes(env) if test(env) else no(env)
    left, right = parts
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    if kind == "in":
        return lambda env: left(env) in (right(env) or ())
    if kind == "add":
        return lambda env: _added(left(env), right(env))
    return lambda env: _entry(left(env), right(env))


def _added(left, right):
    return add(left, right) if isinstance(left, int) and isinstance(right, int) else _shown(left) + _shown(right)


def _entry(value, key):
    if isinstance(value, dict):
        return value.get(key)
    return value[key] if isinstance(value, (list, tuple)) and isinstance(key, int) and key < len(value) else None


@dataclass
class _Output:
    """Parts written so far, their length, and the spans that a model is to write."""

    parts: list[str]
    size: int
    spans: list[tuple[int, int]]

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _action(node) -> Callable[[dict, _Output], None]:
    """The closure of a statement."""
    kind = node[0]
    if kind == "block":
        actions = [_action(inner) for inner in node[1]]

        def block(env, out):
            for action in actions:
                action(env, out)

        return block
    if kind == "write":
        if _is_constant(node[1]):
            return lambda env, out, text=_shown(node[1][1]): out.write(text)
        value = _value(node[1])
        return lambda env, out: out.write(_shown(value(env)))
    if kind == "if":
        test, yes, no = _value(node[1]), _action(node[2]), _action(node[3])
        return lambda env, out: (yes if test(env) else no)(env, out)
    if kind == "set":
        name, value = node[1], _value(node[2])
        return lambda env, out: env.__setitem__(name, value(env))
    if kind == "generation":
        body = _action(node[1])

        def generation(env, out):
            start = out.size
            body(env, out)
            out.spans.append((start, out.size))

        return generation
    name, source, body = node[1], _value(node[2]), _action(node[3])

    def loop(env, out):
        items = list(source(env) or ())
        for k, item in enumerate(items):
            place = {"index": k + 1, "index0": k, "first": k == 0, "last": k == len(items) - 1}
            body({**env, name: item, "loop": place}, out)

    return loop


def _names(node) -> set[str]:
    if isinstance(node, list):
        return set().union(*map(_names, node)) if node else set()
    if not isinstance(node, tuple):
        return set()
    return {node[1]} if node[0] == "name" else set().union(*map(_names, node)) if node else set()


class Template:
    """A compiled template. ``render(messages=[...])`` gives the text and the spans of its generation blocks."""

    def __init__(self, source: str):
        self.tree = fold(_Statements(source).block()[0])
        self._run = _action(self.tree)

    def render(self, **env) -> tuple[str, list[tuple[int, int]]]:
        out = _Output([], 0, [])
        self._run(env, out)
        return "".join(out.parts), out.spans

    @property
    def by_turn(self) -> bool:
        """Whether rendering parts of a conversation one after the other is the same as rendering all of it."""
        nodes = self.tree[1]
        return (len(nodes) == 1 and nodes[0][0] == "for" and nodes[0][2] == ("name", "messages")
                and _names(nodes[0][3]) <= {nodes[0][1]})


#: Turns as ``[INST]role[/INST]text</s>``; only what an assistant says is to be learned.
TURNS = ("{% for m in messages %}[INST]{{ m.role | escape }}[/INST]"
         "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
         "{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}")
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a text that :data:`TURNS` made."""
    turns, at = [], 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            break
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return turns
