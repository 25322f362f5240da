"""Freely typed values mapped to a reference list.

The list's names, aliases and their run-together forms go into one multi-pattern automaton; the mentions found at
word ends are taken longest first, without overlap, and the longest wins. What stands beside a mention may reject it: a
capitalised word next to it belongs to the name of another firm, and so does a part that joins names or has a legal form or
a telling word of another entry; words in small letters, figures and parts set off by a comma, a dash or the like do not.
Other values go to token-set similarity against the entries that share a word less a character with them. What fits
nothing, or fits two entries equally well, is ``unmatched``.

The list is a reference: its size is checked when it is read, and it rides in the function to each worker. Values
are worked on once per distinct value of a batch and remembered, so rows are neither shuffled nor joined.
Null and blank values give null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm import names
from tidemark.llm.lookalike import consistent
from tidemark.session import arrow

UNMATCHED = "unmatched"
#: A reference list beyond this many rows is refused: it would not be a list to send to every worker.
LARGEST = 200_000
REMEMBERED = 100_000


_part = re.compile(r"[,;:()/|\[\]\n]|\s[-–—]+\s|[–—]")
_word = re.compile(r"[^\W_]+(?:[.'’][^\W_]+)*")


def _words(text: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in text.replace("'", "")).split())


@dataclass
class Entry:
    code: str
    names: list[str]
    aliases: list[str] = field(default_factory=list)


class Matcher:
    """Maps one value to a code. ``strict`` lists (firms, persons) want every telling word of a value accounted for."""

    def __init__(self, entries: list[Entry], strict: bool, threshold: float):
        self.strict, self.threshold = strict, threshold
        self.auto = ahocorasick.Automaton()
        self.tokens: dict[str, list[tuple[str, ...]]] = {}
        self.index: dict[str, set[str]] = {}
        owner: dict[str, set[str]] = {}
        for e in entries:
            spelled = [self._telling(n) for n in e.names]
            self.tokens[e.code] = [t for t in spelled if t]
            for t in self.tokens[e.code]:
                for word in t:
                    for v in names.cut_variants(word):
                        self.index.setdefault(v, set()).add(e.code)
            patterns = {" ".join(t) for t in spelled} | {"".join(t) for t in spelled} | {_words(consistent(a)[0]) for a in e.aliases}
            for p in patterns - {""}:
                owner.setdefault(p, set()).add(e.code)
        for p, codes in owner.items():
            if len(codes) == 1:  # a name that two entries share tells neither
                self.auto.add_word(p, (p, next(iter(codes))))
        if len(self.auto):
            self.auto.make_automaton()
        self.telling = {w for spelled in self.tokens.values() for t in spelled for w in t}
        self.known: dict[str, str] = {}

    def _telling(self, name: str) -> tuple[str, ...]:
        return names.parts(name)[0] if self.strict else tuple(_words(consistent(name)[0]).split())

    def mentions(self, text: str) -> list[tuple[int, int, str]]:
        """Mentions that begin and end with a word, the longest first chosen, none overlapping."""
        if not len(self.auto):
            return []
        found = []
        for end, (pattern, code) in self.auto.iter(text):
            start = end - len(pattern) + 1
            if (start == 0 or text[start - 1] == " ") and (end + 1 == len(text) or text[end + 1] == " "):
                found.append((start, end + 1, code))
        chosen: list[tuple[int, int, str]] = []
        for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            if all(m[1] <= c[0] or m[0] >= c[1] for c in chosen):
                chosen.append(m)
        return chosen

    def _by_mention(self, value: str) -> str | None:
        if self.strict:
            tokens, acronym, former = names.parts(value)
            for text in [acronym, "".join(tokens), " ".join(tokens)]:
                hits = self.mentions(text) if text else []
                if len({h[2] for h in hits}) == 1 and sum(h[1] - h[0] for h in hits) >= len(text.replace(" ", "")):
                    return hits[0][2]
            return None
        hits = self.mentions(_words(consistent(value)[0]))
        codes = {h[2] for h in hits if h[1] - h[0] == hits[0][1] - hits[0][0]}
        return hits[0][2] if len(codes) == 1 else None

    def _embedded(self, value: str) -> str | None:
        """The entry whose name stands whole within a longer text that names no other."""
        words: list[tuple[str, int, bool]] = []  # folded word, part of the value, capitalised
        form, joined = set(), set()  # parts with a legal form, parts that join names
        capitals = value != value.lower()
        for k, part in enumerate(_part.split(value)):
            if "&" in part or " and " in part.lower():
                joined.add(k)
            for raw in _word.findall(part):
                folded = _words(consistent(raw)[0])
                if folded in names.FORMS:
                    form.add(k)
                elif folded and not folded.isdigit():
                    words.append((folded, k, capitals and not raw[0].islower()))
        text, starts = "", []
        for w, _, _ in words:
            starts.append(len(text))
            text += w + " "
        hits = self.mentions(text.strip())
        if not hits or len({h[2] for h in hits}) > 1:
            return None
        begin, end, code = hits[0]
        inside = [i for i, at in enumerate(starts) if begin <= at < end]
        parts = {words[i][1] for i in inside}
        if end - begin <= 4 and words[0][1] not in parts:
            return None  # a few letters are a name only where the value begins with them
        own = {w for t in self.tokens[code] for w in t}
        for i, (w, part, capital) in enumerate(words):
            if i in inside:
                continue
            beside = part in parts and (capital or not capitals)
            other = part not in parts and (part in form or part in joined)
            if beside or other or w not in own and len(w) > 1 and w in self.telling:
                return None
        return code

    def _by_similarity(self, value: str) -> str | None:
        tokens = self._telling(value)
        nearby = {c for t in tokens for v in names.cut_variants(t) for c in self.index.get(v, ())}
        scored = sorted(((max(self._score(tokens, t) for t in self.tokens[c]), c) for c in nearby), reverse=True)
        if not scored or scored[0][0] < self.threshold or (len(scored) > 1 and scored[1][0] == scored[0][0]):
            return None
        return scored[0][1]

    def _score(self, tokens: tuple[str, ...], of: tuple[str, ...]) -> float:
        if self.strict:
            return float(names.same_name(tokens, of)) or (names.similarity(tokens, of) if min(len(tokens), len(of)) > 1 else 0.0)
        return sum(any(names.one_edit(t, u) and len(u) > 2 for t in tokens) for u in of) / len(of)

    def code(self, value: str) -> str:
        found = self.known.get(value)
        if found is None:
            found = UNMATCHED if self.strict and names.is_filler(value) else self._by_mention(value) or (self._embedded(value) if self.strict else None) or self._by_similarity(value) or UNMATCHED
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[value] = found
        return found


def read_list(rows: DataFrame, code: str, name: str, alias: str | None = None, extra: dict[str, list[str]] | None = None) -> list[Entry]:
    """The entries of a reference table; rows without a code or name are left out, repeated codes joined."""
    taken = rows.select(F.col(code).alias("c"), F.col(name).alias("n"), (F.col(alias) if alias else F.lit(None).cast("string")).alias("a")).filter("c is not null and n is not null").limit(LARGEST + 1).collect()
    if len(taken) > LARGEST:
        raise ValueError(f"a reference list may have {LARGEST} rows at most")
    entries: dict[str, Entry] = {}
    for r in taken:
        e = entries.setdefault(r.c, Entry(r.c, [], list((extra or {}).get(r.c, []))))
        e.names.append(r.n)
        if r.a:
            e.aliases.append(r.a)
    return [entries[c] for c in sorted(entries)]


_MATCHERS: dict[str, Matcher] = {}


def map_to_list(value: Column | str, entries: list[Entry], strict: bool = True, threshold: float = 1.0) -> Column:
    """The code of the entry a value means, ``unmatched``, or null for a null or blank value."""
    name = f"{strict}{threshold}{entries!r}"

    @arrow(StringType())
    def to_code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _MATCHERS:
            _MATCHERS[name] = Matcher(entries, strict, threshold)
        code = _MATCHERS[name].code
        for batch in batches:
            coded = batch.dictionary_encode()
            yield pa.array([None if v is None or not consistent(v)[0] else code(v) for v in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)

    return to_code(value)
