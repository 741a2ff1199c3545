"""A parser for the Turtle that catalogues use: prefixes, base, lists of predicates and objects, literals, blank nodes."""

from __future__ import annotations

import re
import urllib.parse
from collections.abc import Iterator

from quernstone.errors import ParseError

#: Fixed value.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
_TOKENS = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
    |(?P<iri><[^<>"{}|^`\\\s]*>)
    |(?P<text>\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<type>\^\^)
    |(?P<number>[+-]?(?:\d+\.\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|\d+(?:[eE][+-]?\d+)?))
    |(?P<blank>_:[\w.-]*\w)
    |(?P<name>(?:[A-Za-z_][\w.-]*)?:(?:[\w:%-]|\\.|\.(?=[\w:%-]))*|[A-Za-z]+)
    |(?P<mark>[.;,\[\]()])""",
    re.X | re.S,
)
_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(s: str) -> str:
    def one(m: re.Match) -> str:
        c = m[1]
        return chr(int(c[1:], 16)) if c[0] in "uU" and len(c) > 1 else _ESCAPES.get(c, c)

    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", one, s, flags=re.S)


class _Reader:
    def __init__(self, text: str) -> None:
        self.items: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TOKENS.match(text, at)
            if m is None:
                raise ParseError(f"unreadable Turtle at {text[at : at + 30]!r}")
            if m.lastgroup != "skip":
                self.items.append((m.lastgroup, m[0]))
            at = m.end()
        self.i, self.blanks = 0, 0
        self.prefixes: dict[str, str] = {}
        self.base = ""
        self.out: list[tuple[str, str, str]] = []

    def peek(self) -> tuple[str, str]:
        return self.items[self.i] if self.i < len(self.items) else ("end", "")

    def next(self) -> tuple[str, str]:
        got = self.peek()
        self.i += 1
        return got

    def expect(self, mark: str) -> None:
        if self.next()[1] != mark:
            raise ParseError(f"{mark!r} expected before {self.peek()[1]!r}")

    def fresh(self) -> str:
        self.blanks += 1
        return f"_:b{self.blanks}"

    def resource(self, kind: str, s: str) -> str:
        if kind == "iri":
            return urllib.parse.urljoin(self.base, _unescape(s[1:-1])) if self.base else _unescape(s[1:-1])
        if kind == "blank":
            return s
        if kind == "name" and ":" in s:
            prefix, _, local = s.partition(":")
            if prefix not in self.prefixes:
                raise ParseError(f"unknown prefix {prefix!r}")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        raise ParseError(f"a resource expected at {s!r}")

    def node(self) -> str:
        kind, s = self.next()
        if s == "[":
            b = self.fresh()
            if self.peek()[1] != "]":
                self.predicates(b)
            self.expect("]")
            return b
        if s == "(":
            first = prev = ""
            while self.peek()[1] != ")":
                cell = self.fresh()
                self.out.append((prev, f"{RDF}rest", cell)) if prev else None
                first = first or cell
                self.out.append((cell, f"{RDF}first", self.node()))
                prev = cell
            self.next()
            if prev:
                self.out.append((prev, f"{RDF}rest", f"{RDF}nil"))
            return first or f"{RDF}nil"
        if kind == "text":
            n = 3 if s[:3] in ('"""', "'''") else 1
            value = _unescape(s[n:-n])
            if self.peek()[0] == "lang":
                self.next()
            elif self.peek()[0] == "type":
                self.next()
                self.resource(*self.next())
            return value
        if kind == "number" or s in ("true", "false"):
            return s
        return self.resource(kind, s)

    def predicates(self, subject: str) -> None:
        while True:
            kind, s = self.next()
            p = f"{RDF}type" if s == "a" else self.resource(kind, s)
            while True:
                self.out.append((subject, p, self.node()))
                if self.peek()[1] != ",":
                    break
                self.next()
            while self.peek()[1] == ";":
                self.next()
                if self.peek()[1] in (".", "]"):
                    return
                if self.peek()[1] != ";":
                    break
            else:
                return

    def run(self) -> list[tuple[str, str, str]]:
        while self.peek()[0] != "end":
            kind, s = self.peek()
            if s.lower() in ("@prefix", "prefix", "@base", "base"):
                self.next()
                if s.lower().endswith("prefix"):
                    name = self.next()[1].rstrip(":")
                    self.prefixes[name] = self.resource(*self.next())
                else:
                    self.base = self.resource(*self.next())
                if s[0] == "@":
                    self.expect(".")
                continue
            subject = self.node()
            if self.peek()[1] != ".":
                self.predicates(subject)
            self.expect(".")
        return self.out


def triples(text: str) -> Iterator[dict[str, str]]:
    """Distinct {subject, predicate, object} of a Turtle text; literals without their language or type."""
    if text.lstrip().startswith("<?xml"):
        raise ParseError("RDF/XML is not Turtle")
    for s, p, o in dict.fromkeys(_Reader(text).run()):
        yield {"subject": s, "predicate": p, "object": o}
