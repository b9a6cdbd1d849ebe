"""Assignments in source code and configuration: names, the literals they get, and how secret they look.

Works on one text in plain Python; ``secret_scan`` runs it over a table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""
      (?P<text>(?<![\w"'`\\])[rbfuRBFU]{0,2}
          (?: \"\"\"(?:[^"\\]|\\.|\"(?!\"\"))*\"\"\" | '''(?:[^'\\]|\\.|'(?!''))*'''
            | "[^"\\]*(?:\\.[^"\\]*)*" | '[^'\\]*(?:\\.[^'\\]*)*' | `[^`\\]*(?:\\.[^`\\]*)*` ))
    | (?P<name>[$@%]?[^\W\d]\w*(?:[.-][^\W\d]\w*)*)
    | (?P<op>:=|=>|[=!<>]=|=~|\+=|::|->|[=:+])
    | (?P<rest>[^\s\w]|\w+)
    """,
    re.VERBOSE,
)
_QUOTES = re.compile(r"""[rbfuRBFU]{0,2}(\"\"\"|'''|["'`])""")
_ASSIGNS = ("=", ":", ":=", "=>", "+=")
# A value without quotes ends at white space or at what closes or parts values.
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
_SCHEME = re.compile(r"(?:bearer|basic|token)\x20+", re.IGNORECASE)
_REFERENCE = re.compile(r"\$\{?(\w+)\}?|\{\{?\s*(\w+)\s*\}?\}|%\((\w+)\)s")
_OPTION = re.compile(r"(?<!\S)--([A-Za-z][\w-]*)\x20+(?!-)")
_LOGIN = re.compile(r"://[^\s:/@\"']*:([^\s/@\"']+)@")
_ELEMENT = re.compile(r"<([A-Za-z][\w.-]*)(?:\s[^<>]*)?>([^<>\s]+)</\1>")

# Parts of names, and how far each speaks for a secret.
NAME_PARTS = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "passcode": 3, "pass": 2,
    "secret": 3, "secrets": 3, "token": 3, "credential": 3, "credentials": 3, "apikey": 3,
    "authorization": 3, "auth": 1, "bearer": 2, "pat": 1, "key": 1, "signature": 1, "salt": 2,
    "api": 1, "access": 1, "private": 2, "signing": 2, "encryption": 2, "master": 1, "client": 1,
    "login": 1, "session": 1, "webhook": 1, "psk": 3, "jwt": 3,
    "id": -3, "name": -3, "count": -3, "length": -3, "len": -3, "size": -3, "limit": -3,
    "max": -3, "min": -3, "type": -3, "url": -2, "uri": -2, "path": -3, "file": -3, "dir": -3,
    "field": -3, "label": -3, "hint": -3, "prompt": -3, "policy": -3, "ttl": -3, "expiry": -3,
    "expires": -3, "public": -3, "column": -3, "index": -2, "header": -1, "message": -3, "error": -3,
}
# Published beginnings of keys.
KNOWN_FORMS = re.compile(
    r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|xox[abpr]-|sk[-_](?:live|test|ant|proj)|[rp]k_live|AIza|eyJ[\w-]+\.|SG\.|npm_|pypi-)"
)
# What stands where a secret will be.
PLACEHOLDER = re.compile(
    r"^(?:(.)\1*|.*(?:example|changeme|change[_-]me|placeholder|redacted|your[_-]|insert[_-]|dummy|sample|xxxx).*"
    r"|none|null|nil|true|false|undefined|required|optional|string|default|unknown|todo|tbd|test(?:ing)?"
    r"|<.*>|\$\{?\w+\}?|\{\{.*\}\}|%\(.*\)s|process\.env\..*|os\.environ.*)$",
    re.IGNORECASE,
)
THRESHOLD = 5


@dataclass
class Literal:
    """What a name got: the text, where its characters stand, and whether it was quoted."""

    value: str
    places: list[tuple[int, int]]
    quoted: bool


@dataclass
class Pair:
    name: str
    literal: Literal


def name_parts(name: str) -> list[str]:
    """``dbPassword`` and ``db-password`` → ``db, password``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ", name)
    return [p for p in re.split(r"[^A-Za-z0-9]+", spaced.lower()) if p]


def name_score(name: str) -> int:
    """How far a name says that what it holds is secret; its last three parts count."""
    parts = name_parts(name)[-3:]
    return sum(NAME_PARTS.get(p, 0) for p in parts)


def value_score(value: str, quoted: bool) -> int:
    """How far a literal looks like a secret; far below 0 if it surely is none."""
    n = len(value)
    if n < 6 or PLACEHOLDER.match(value):
        return -99
    counts = Counter(value)
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    digit, lower, upper = (any(map(f, value)) for f in (str.isdigit, str.islower, str.isupper))
    score = (n >= 8) + (n >= 16) + (bits >= 3) + digit + (lower and upper) + (not value.isalnum())
    if KNOWN_FORMS.match(value):
        score += 4
    if " " in value:
        score -= 3
    if value.isdigit() and n < 8:
        score -= 3
    # A word of prose behind a colon, and not a value.
    if not quoted and value.strip(".-_!?").isalpha() and value[1:].islower():
        score -= 4
    return score


@dataclass
class Lexer:
    """Name-literal pairs of a text, constants followed to the names that get them."""

    text: str
    known: dict[str, Literal] = field(default_factory=dict)

    def pairs(self) -> Iterator[Pair]:
        for start, end in self._statements():
            yield from self._line(start, end)
        for pattern in (_OPTION, _LOGIN, _ELEMENT) if re.search("--|://|</", self.text) else ():
            yield from self._others(pattern)

    def _statements(self) -> Iterator[tuple[int, int]]:
        """Lines with an operator, joined with the next one where a line ends in one."""
        at, n = 0, len(self.text)
        operator = re.compile("[=:]")
        while found := operator.search(self.text, at):
            start = self.text.rfind("\n", at, found.start()) + 1 or at
            end = self.text.find("\n", found.start())
            end = n if end < 0 else end
            while end < n and self.text[max(start, end - 80) : end].rstrip()[-1:] in ("=", "+", "\\"):
                after = self.text.find("\n", end + 1)
                end = n if after < 0 else after
            yield start, end
            at = end

    def _line(self, start: int, end: int) -> Iterator[Pair]:
        tokens = [m for m in _TOKEN.finditer(self.text, start, end) if m.group() != "\\"]
        i = 0
        while i < len(tokens):
            name, i = self._target(tokens, i)
            if name is None:
                continue
            literal, i = self._expression(tokens, i, end)
            if literal is None:
                continue
            self.known[name] = literal
            yield Pair(name, literal)

    @staticmethod
    def _target(tokens: list[re.Match], i: int) -> tuple[str | None, int]:
        """A name (or quoted key) and its operator from ``i`` on; the place behind them."""
        kind, own = tokens[i].lastgroup, tokens[i].group()
        if kind not in ("name", "text"):
            return None, i + 1
        name = own if kind == "name" else own.strip("rbfuRBFU\"'`") if len(own) < 100 else ""
        j = i + 1
        while j < len(tokens) and tokens[j].group() in ("]", ")"):
            j += 1
        if not name or j >= len(tokens) or tokens[j].group() not in _ASSIGNS:
            return None, i + 1
        j += 1
        # An annotation between the name and its value.
        if (
            tokens[j - 1].group() == ":" and j + 1 < len(tokens)
            and tokens[j].lastgroup == "name" and tokens[j + 1].group() == "="
        ):
            j += 2
        return name, j

    def _expression(self, tokens: list[re.Match], i: int, end: int) -> tuple[Literal | None, int]:
        """Literals joined by plus signs, constants put in; the place behind what was read."""
        values: list[str] = []
        places: list[tuple[int, int]] = []
        quoted, following = False, i
        while following < len(tokens):
            token = tokens[following]
            if token.lastgroup == "text":
                value, place = self._inside(token)
                values.append(self._filled(value, places))
                places.append(place)
                quoted, following = True, following + 1
            elif not values and (bare := self._bare(token.start(), end)) is not None:
                value, place, constant = bare
                if constant is not None:
                    values.append(constant.value)
                    places += constant.places
                    quoted = quoted or constant.quoted
                    following += 1
                else:
                    called = following + 1 < len(tokens) and tokens[following + 1].group() == "("
                    if called:
                        return self._argument(tokens, following + 2)
                    values.append(self._filled(value, places))
                    places.append(place)
                    while following < len(tokens) and tokens[following].start() < place[1]:
                        following += 1
            elif token.lastgroup == "name" and token.group().lstrip("$") in self.known:
                constant = self.known[token.group().lstrip("$")]
                values.append(constant.value)
                places += constant.places
                following += 1
            else:
                break
            if following >= len(tokens) or tokens[following].group() != "+":
                break
            following += 1
        if not places:
            # What stands here may itself be a target.
            return None, i
        return Literal("".join(values), places, quoted), following

    def _argument(self, tokens: list[re.Match], i: int) -> tuple[Literal | None, int]:
        """The last string handed to a call; of a look-up only a default, behind the name."""
        getter = re.search(r"env|get", tokens[i - 2].group(), re.IGNORECASE)
        strings = []
        j = i
        while j < len(tokens) and tokens[j].group() not in (")", "=", ":"):
            if tokens[j].lastgroup == "text":
                strings.append(tokens[j])
            j += 1
        if j < len(tokens) and tokens[j].group() in ("=", ":"):
            return None, i  # named arguments are pairs of their own
        if len(strings) < (2 if getter else 1):
            return None, j
        value, place = self._inside(strings[-1])
        return Literal(value, [place], True), j

    @staticmethod
    def _inside(token: re.Match) -> tuple[str, tuple[int, int]]:
        quote = _QUOTES.match(token.group())
        start, end = token.start() + quote.end(), token.end() - len(quote.group(1))
        return token.string[start:end], (start, end)

    def _bare(self, at: int, end: int) -> tuple[str, tuple[int, int], Literal | None] | None:
        scheme = _SCHEME.match(self.text, at, end)
        found = _BARE.match(self.text, scheme.end() if scheme else at, end)
        if not found:
            return None
        value = found.group().rstrip(".:")
        return value, (found.start(), found.start() + len(value)), self.known.get(value.lstrip("$"))

    def _filled(self, value: str, places: list[tuple[int, int]]) -> str:
        """Constants put in for ``${name}``, ``{name}`` and ``%(name)s``, their places noted."""

        def put(m: re.Match) -> str:
            constant = self.known.get(m.group(1) or m.group(2) or m.group(3))
            if constant is None:
                return m.group()
            places.extend(constant.places)
            return constant.value

        return _REFERENCE.sub(put, value) if "{" in value or "$" in value or "%(" in value else value

    def _others(self, pattern: re.Pattern) -> Iterator[Pair]:
        """Options with a value behind them, passwords in addresses, elements of one value."""
        for m in pattern.finditer(self.text):
            if pattern is _OPTION:
                bare = _BARE.match(self.text, m.end())
                if bare:
                    yield Pair(m.group(1), Literal(bare.group(), [bare.span()], False))
            elif pattern is _LOGIN:
                yield Pair("password", Literal(m.group(1), [m.span(1)], True))
            else:
                yield Pair(m.group(1), Literal(m.group(2), [m.span(2)], True))


def scored_literals(text: str) -> dict[tuple[int, int], int]:
    """Places of literals that flow into sensitive names, each with its best score."""
    found: dict[tuple[int, int], int] = {}
    for pair in Lexer(text).pairs():
        by_name = name_score(pair.name)
        if by_name < 2:
            continue
        score = by_name + value_score(pair.literal.value, pair.literal.quoted)
        for place in pair.literal.places:
            if place[0] < place[1]:
                found[place] = max(score, found.get(place, score))
    return found
