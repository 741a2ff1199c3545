"""Several values packed in one field, split by a parsing expression grammar.

    list  <- gap* (value gap+)* value? gap*
    value <- quoted / escaped / bracketed / bare

The choices are ordered and look ahead without limit. A quoted value is tried first; where its quote
is not closed before a delimiter the parser goes back and reads the same place as a bare value,
setting the flag ``quote``. Brackets around values hold a list of their own, brackets within a value
belong to it; brackets that are never closed are read as plain signs (flag ``bracket``). Runs of
delimiters and pairs of brackets are found once for a text, so a text is read in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Value:
    text: str
    flag: str | None = None


@dataclass(frozen=True)
class Grammar:
    """What separates values and, if values have a form of their own, how they begin.

    delimiters: a character class without its brackets. start: a pattern every value begins with;
    then a delimiter counts only if a value or the end follows, so values may hold delimiters.
    """

    delimiters: str
    start: str | None = None
    quotes: str = "\"'"
    pairs: str = "[]()"

    @cached_property
    def opening(self) -> re.Pattern:
        """What may stand before a value's first character."""
        return re.compile(rf"[{self.quotes}\\\s{re.escape(self.pairs[::2])}]*+{self.start or ''}")

    @cached_property
    def event(self) -> re.Pattern:
        """An opening bracket, or a run of delimiters and closing brackets."""
        return re.compile(rf"[{re.escape(self.pairs[::2])}]|[{self.delimiters}{re.escape(self.pairs[1::2])}]+")

    @cached_property
    def gap(self) -> re.Pattern:
        return re.compile(rf"[\s{self.delimiters}]*+")

    @cached_property
    def bracket(self) -> re.Pattern:
        return re.compile(f"[{re.escape(self.pairs)}]")

    @cached_property
    def quoted(self) -> dict[str, re.Pattern]:
        """quote -> a value that runs to it; doubled and escaped quotes belong to the value."""
        return {q: re.compile(rf"{q}((?:[^{q}\\]|\\.|{q}{q})*+){q}", re.S) for q in self.quotes}


class Reading:
    """One text being read."""

    def __init__(self, grammar: Grammar, text: str) -> None:
        self.g, self.s = grammar, text
        self.close: dict[int, int] = {}
        open_: dict[str, list[int]] = {c: [] for c in grammar.pairs[1::2]}
        kind = dict(zip(grammar.pairs[::2], grammar.pairs[1::2], strict=True))
        for m in grammar.bracket.finditer(text):
            if m[0] in kind:
                open_[kind[m[0]]].append(m.start())
            elif open_[m[0]]:
                self.close[open_[m[0]].pop()] = m.start()

    def follows(self, i: int, hi: int) -> int | None:
        """The place after the gap at ``i`` if a value or the end may come there."""
        j = self.g.gap.match(self.s, i, hi).end()
        if j == hi:
            return j
        if self.g.start is None:
            return j if self.s[i:j].strip() else None
        return j if self.g.opening.match(self.s, j, hi) else None

    def unescape(self, text: str, q: str) -> Value:
        return Value(re.sub(r"\\(.)", r"\1", text.replace(q + q, q), flags=re.S).strip())

    def closed(self, i: int, hi: int) -> tuple[Value, int] | None:
        """A value in quotes, or in escaped quotes."""
        c = self.s[i]
        if c in self.g.quotes:
            m = self.g.quoted[c].match(self.s, i, hi)
            if m and self.follows(m.end(), hi) is not None:
                return self.unescape(m[1], c), m.end()
        elif c == "\\" and i + 1 < hi and (q := self.s[i + 1]) in self.g.quotes:
            j = self.s.find("\\" + q, i + 2, hi)
            while j >= 0:
                if self.follows(j + 2, hi) is not None:
                    return self.unescape(self.s[i + 2 : j], q), j + 2
                j = self.s.find("\\" + q, j + 2, hi)
        return None

    def bare(self, i: int, hi: int) -> tuple[Value, int]:
        """Up to a run of delimiters, outside the value's own brackets, after which a value or the end follows."""
        at = i
        while m := self.g.event.search(self.s, at, hi):
            at = m.end()
            if m.start() in self.close:
                at = self.close[m.start()] + 1
                if at > hi:
                    break
            elif m[0] in self.g.pairs[::2]:
                continue
            elif m.start() > i and (self.g.start is None or self.ends(m, hi)):
                if self.g.start is None and not re.search(f"[{self.g.delimiters}]", m[0]):
                    continue  # a lone closing bracket
                return self.clean(self.s[i : m.start()]), m.start()
        return self.clean(self.s[i:hi]), hi

    def ends(self, run: re.Match, hi: int) -> bool:
        return run.end() == hi or self.g.opening.match(self.s, run.end(), hi) is not None

    def clean(self, text: str) -> Value:
        """Without escape marks and stray quotes, which are flagged."""
        t = re.sub(r"\\(.)", r"\1", text, flags=re.S).strip()
        inner = t.strip(self.g.quotes).strip()
        return Value(inner, "quote" if inner != t else None)

    def values(self) -> Iterator[Value]:
        todo = [(0, len(self.s))]  # lists still to be read, the innermost last
        pairs, odd = self.g.pairs, False
        while todo:
            i, hi = todo.pop()
            while True:
                i = self.g.gap.match(self.s, i, hi).end()
                if i >= hi:
                    break
                if (got := self.closed(i, hi)) is None and (c := self.s[i]) in pairs:
                    end = self.close.get(i, hi)
                    if end < hi and self.follows(end + 1, hi) is not None:
                        todo.append((end + 1, hi))
                        i, hi = i + 1, end
                        continue
                    if self.g.start is not None and (end >= hi or c in pairs[1::2]):
                        odd, i = True, i + 1  # never opened or never closed
                        continue
                v, i = got or self.bare(i, hi)
                if v.text:
                    yield Value(v.text, v.flag or ("bracket" if odd else None))
                odd = False


# --- facets ------------------------------------------------------------------------------------

#: The delimiters of facets; a facet begins with its group.
FACETS = Grammar(r"\s$|;,/£", r"F\d\d\.")
#: Values without a form of their own; blanks and slashes do not separate them.
FREE = Grammar(r"$|;,£\t\n")
_OWN = re.compile(r"\s*+[\"'\[\\]*+\s*+[^\s#$|;,/\"'.]*+\s*+#")


def separated(text: str | None, grammar: Grammar = FREE) -> list[Value]:
    """The values of one string under a grammar."""
    return list(Reading(grammar, text).values()) if text else []


def facets(text: str | None) -> list[Value]:
    """The facet values of one string; the term's own code up to # is none.

    A string in which nothing begins as facets do is read as values of any form.
    """
    if not text or not text.strip():
        return []
    s = text.strip()
    if own := _OWN.match(s):
        s = s[own.end() :]
        # a quote that encloses own code and values together
        q = own[0].strip().rstrip("#").strip()[:1]
        if q and q in FACETS.quotes and s.rstrip().endswith(q) and s.count(q) % 2:
            s = s.rstrip()[:-1]
    return separated(s, FACETS if re.search(FACETS.start, s) else FREE)


# --- notes and references ----------------------------------------------------------------------

#: A delimiter beyond ASCII may be written in the two characters its UTF-8 bytes make elsewhere.
_MISREAD = "£".encode().decode("cp1252")
_NGAP = rf"(?:{_MISREAD}|[\s£|;,])"
_REF = re.compile(rf"https?://(?:(?!{_MISREAD})[^\s£|;,\"'])+|doc:[A-Za-z]{{2}}-\d+")
_WRAP = r"[\"'\\]*+"
_GAPS, _PIECE = re.compile(rf"{_NGAP}*+"), re.compile(rf"(?:(?!{_MISREAD})[^\s£|;,])+")
_FIRST, _BETWEEN, _LAST = re.compile(rf"{_WRAP}(?={_REF.pattern})"), re.compile(rf"{_WRAP}{_NGAP}++{_WRAP}"), re.compile(rf"{_WRAP}{_NGAP}*+")
_BEFORE = re.compile(rf"{_NGAP}+{_WRAP}$")
_NOTED = {q: re.compile(rf"{q}((?:[^{q}\\]|\\.|{q}{q})*+){q}", re.S) for q in "\"'"}


def _tail(s: str, lo: int) -> int:
    """Where the references that end the text begin: the gap before them, or the end of the text without its last gap."""
    refs = list(_REF.finditer(s, lo))
    at, begin = len(s), None
    for k in range(len(refs) - 1, -1, -1):
        between = _LAST if k == len(refs) - 1 else _BETWEEN
        if not between.fullmatch(s, refs[k].end(), at):
            break
        at = refs[k].start()
        # the gap before a reference, looked for after the one before it
        before = _BEFORE.search(s, refs[k - 1].end() if k else lo, at)
        if before is None:
            break
        begin = before.start()
    if begin is not None:
        return begin
    j = len(s)
    while j > lo:  # the last gap
        if s.endswith(_MISREAD, lo, j):
            j -= len(_MISREAD)
        elif s[j - 1].isspace() or s[j - 1] in "£|;,":
            j -= 1
        else:
            break
    return j


def note(text: str | None) -> list[Value]:
    """The note text, if there is one, and the references after it."""
    if not text or not text.strip():
        return []
    s, out = text.strip(), []
    i = _GAPS.match(s).end()
    if i < len(s) and not _FIRST.match(s, i):
        m = _NOTED[s[i]].match(s, i) if s[i] in _NOTED else None
        end = _tail(s, m.end() - 1 if m else i)
        if m and (_GAPS.match(s, m.end()).end() == len(s) or end <= m.end()):
            v, i = re.sub(r"\\(.)", r"\1", m[1].replace(s[i] * 2, s[i]), flags=re.S).strip(), m.end()
        else:
            end = _tail(s, i)
            v, i = re.sub(r"\\([\"'\\£|;])", r"\1", s[i:end]).strip(), end
        if v:
            out.append(Value(v))
    while True:
        i = _GAPS.match(s, i).end()
        if i >= len(s):
            return out
        j = _FIRST.match(s, i)
        if j:
            m = _REF.match(s, j.end())
            out.append(Value(m[0].strip()))
            i = re.compile(_WRAP).match(s, m.end()).end()
        else:
            m = _PIECE.match(s, i)
            out.append(Value(m[0].strip(), "no reference"))
            i = m.end()


PARSERS = {"facets": facets, "note": note, "values": separated}


def unpack(df: DataFrame, parser: str, least: int = 1) -> DataFrame:
    """(rec_id, field, pos, value, flag), one row per value.

    ``df``: (rec_id, field, packed ARRAY<STRING>); the count runs on through the array. Null
    arrays, null elements and blank texts give no rows; rows with fewer than ``least`` values are
    left out. pos counts from 1. ``flag`` is ``quote`` where a quote was never closed (the text is
    then read as bare), ``bracket`` after a bracket without its partner, ``no reference`` for an
    unreadable piece of a note, else null. Texts of any
    length are read whole.
    """
    parse = PARSERS[parser]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for rec, field, packed in zip(b["rec_id"], b["field"], b["packed"], strict=True):
                values = [v for text in packed for v in parse(text)] if packed is not None else []
                if len(values) >= least:
                    rows += [(rec, field, k, v.text, v.flag) for k, v in enumerate(values, 1)]
            yield pd.DataFrame(rows, columns=["rec_id", "field", "pos", "value", "flag"])

    return df.select("rec_id", "field", "packed").where(F.col("packed").isNotNull()).mapInPandas(run, "rec_id bigint, field string, pos int, value string, flag string")
