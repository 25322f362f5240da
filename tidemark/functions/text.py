"""Text functions as Catalyst expressions.

Patterns are Java's. ``FLAGS`` makes classes, case folding and line ends behave as in Unicode-aware engines: without
``U`` a no-break space is no blank, without ``d`` other line separators end a line.
"""

from __future__ import annotations

import html
import re as _re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.session import arrow

FLAGS = "(?iUd)"
_ON, _OFF = "\u0001", "\u0002"


def collapse(text: Column) -> Column:
    """Runs of blanks to one, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a higher-order function an expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(text: Column) -> Column:
    """No blanks of any kind at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def mask(text: Column, pattern: str) -> Column:
    """Every match replaced by as many blanks, so that positions stay."""
    clean = F.translate(text, _ON + _OFF, "  ")
    pieces = F.split(F.regexp_replace(clean, pattern, f"{_ON}$0{_OFF}"), _ON)

    def blank(piece: Column) -> Column:
        at = F.instr(piece, _OFF)
        return F.when(at > 0, F.concat(F.rpad(F.lit(""), at - 1, " "), F.substr(piece, at + 1))).otherwise(piece)

    return F.array_join(F.transform(pieces, blank), "")


def last_match(text: Column, pattern: str) -> Column:
    """Start of the last of the matches found from left to right, -1 without one; null for null."""

    def place(marked: Column) -> Column:
        at = F.length(marked) - F.instr(F.reverse(marked), _ON)  # marks stand before matches, one for each
        marks = F.length(marked) - F.length(F.translate(marked, _ON, ""))
        return F.when(marks > 0, at - marks + 1).otherwise(F.lit(-1))

    marked = F.regexp_replace(F.translate(text, _ON, " "), pattern, f"{_ON}$0")
    return let(marked, place)


def sentences(text: Column) -> Column:
    """Pieces that end in a full stop or semicolon before a blank."""
    return F.split(collapse(text), r"(?<=[.;])\s+")


def drop_sentences(text: Column, pattern: str) -> Column:
    """The text without the sentences in which ``pattern`` occurs."""
    return F.array_join(F.filter(sentences(text), lambda s: (F.trim(s) != "") & ~s.rlike(pattern)), " ")


#: What changes from one report to the next without meaning.
_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
#: Ends of words spelled out: Java's own take an accent that stands by itself for a part of the word.
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def normalise_for_diff(text: Column) -> Column:
    """Lower-case words only: figures, months and quarter names are dropped."""
    t = F.lower(text)
    t = F.regexp_replace(t, r"\b\d[\d,.]*\b", " ")
    t = F.regexp_replace(t, rf"{_BEFORE}({_MONTHS}){_AFTER}", " ")
    t = F.regexp_replace(t, rf"{_BEFORE}(first|second|third|fourth)(?:(?U:\s)|[\x1c-\x1f])+quarter{_AFTER}", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^a-z ]+", " "), " +", " "))


def _runs(text: Column, size: int, of: Callable[[Column], Column], kind: str) -> Column:
    def runs(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: of(F.array_join(F.slice(words, i, size), " ")))
        return F.when(F.size(words) >= size, F.array_distinct(each)).otherwise(F.array().cast(kind))

    return let(F.split(text, " "), runs)


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct runs of ``size`` words; none for a shorter text."""
    return _runs(text, size, lambda run: run, "array<string>")


def shingle_hashes(text: Column, size: int = 5) -> Column:
    """The same as 64-bit hashes, which travel lighter."""
    return _runs(text, size, F.xxhash64, "array<bigint>")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 1 where either is empty, as nothing can be compared."""

    def share(s: Column) -> Column:
        x, y = s["a"], s["b"]
        return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(1.0)).otherwise(let(F.size(F.array_intersect(x, y)), lambda both: both / (F.size(x) + F.size(y) - both)))

    return let(F.struct(a.alias("a"), b.alias("b")), share)


def truncate_words(text: Column, limit: int) -> Column:
    """Cut before the limit at a blank (if that leaves more than six tenths), closed by an ellipsis."""
    t = collapse(text)
    head = F.substring(t, 1, limit)
    at = F.length(head) - F.instr(F.reverse(head), " ")
    cut = F.when((F.instr(head, " ") > 0) & (at > limit * 0.6), F.substr(head, F.lit(1), at)).otherwise(head)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.regexp_replace(cut, r"[ ,;:\-]+$", ""), F.lit("…")))


def open_quote(text: Column) -> Column:
    """Without a leading note number; with a leading ellipsis unless it opens as a sentence does."""
    t = F.regexp_replace(strip(text), "^\\d{1,3}\\s*[.:–—-]?\\s+(?=[A-Z“\"(])", "")
    return F.when((t == "") | t.rlike("^[A-Z“(\"•…]"), t).otherwise(F.concat(F.lit("… "), t))


def close_quote(text: Column) -> Column:
    """Without invisible characters; with a closing ellipsis unless it ends as a sentence does."""
    t = strip(F.translate(text, "\u200b\u200c\u200d\ufeff\u00ad", ""))
    done = t.rlike("[.!?;:\"”’)\\]…]$")
    return F.when((t == "") | done, t).otherwise(F.concat(F.regexp_replace(t, "[ ,;:–—-]+$", ""), F.lit("…")))


def novel_sentences(current: Column, prior: Column, least: int = 60, most: int = 3, longest: int = 320) -> Column:
    """The first sentences of ``current`` that share no run of words with ``prior`` (its ``shingle_hashes``), as quotes."""

    def fresh(s: Column, old: Column) -> Column:
        runs = shingle_hashes(normalise_for_diff(s))
        return (F.length(s) >= least) & s.rlike("^[\\p{Lu}“(\"]") & let(runs, lambda r: (F.size(r) > 0) & ~F.arrays_overlap(r, old))

    def pick(both: Column) -> Column:
        parts = F.split(both["text"], r"(?<=[.;])\s+")
        whole = F.when(both["text"].rlike(r"[.;!?]\s*$"), parts).otherwise(let(parts, lambda p: F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))))
        kept = F.slice(F.filter(F.transform(whole, F.trim), lambda s: fresh(s, both["old"])), 1, most)
        return F.transform(kept, lambda s: open_quote(close_quote(truncate_words(s, longest))))

    return let(F.struct(current.alias("text"), prior.alias("old")), pick)


def looks_like_heading(line: Column) -> Column:
    """Short, not ending in a comma, colon or semicolon, not starting in lower case."""
    t = F.trim(line)
    return (F.length(t) > 0) & (F.length(t) <= 70) & ~t.rlike(r"[,;:]$") & ~t.rlike(r"^\p{Ll}")


def mid_sentence(label: Column) -> Column:
    """The label as it reads inside a sentence: a leading capital falls unless the word is an acronym."""
    first, rest = F.substring(label, 1, 1), F.substr(label, F.lit(2))
    return F.when(label.rlike(r"^\p{Lu}[\p{Lu}\d]"), label).otherwise(F.concat(F.lower(first), rest))


def first_positions(text: Column, patterns: dict[str, str]) -> Column:
    """Names of the patterns that occur, by the place of their first match, then by name."""
    found = F.filter(
        F.array(*[F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(n).alias("name")) for n, p in patterns.items()]),
        lambda s: s["at"] > 0,
    )
    return F.transform(F.array_sort(found), lambda s: s["name"])


def ordered_distinct(values: Column, most: int | None = None) -> Column:
    """Distinct regardless of case, the first spelling kept."""
    lowered = F.transform(values, lambda v: F.lower(v))
    kept = F.filter(values, lambda v, i: F.array_position(lowered, F.lower(v)) == i + 1)
    return F.slice(kept, 1, most) if most else kept


def html_blocks(raw: Column) -> Column:
    """Markup to text with block ends as line ends; entities are left for ``unescape``."""
    t = F.regexp_replace(raw, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)</?(?:p|div|br|tr|table|li|ul|ol|h[1-6]|hr|section|article|title|td|th)\b[^>]*>", "\n")
    return F.regexp_replace(t, r"</?[A-Za-z][^>]*>", "")


def tidy_lines(text: Column) -> Column:
    """Blanks inside lines to one, empty lines dropped, none at the ends."""
    t = F.regexp_replace(F.translate(text, "\u00a0", " "), r"[ \t\r\f\x0B]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r" ?\n[ \n]*", "\n"), r"^\n|\n$", ""))


def unescape(text: Column | str) -> Column:
    """Character references resolved, those of HTML 5 included: there is no built-in for the named ones."""

    @arrow(StringType())
    def resolve(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())

    return resolve(text)


def html_to_text(raw: Column) -> Column:
    """Markup to text; only texts that hold a character reference visit Python."""
    blocks = html_blocks(raw)
    return tidy_lines(F.when(raw.contains("&"), unescape(F.when(raw.contains("&"), blocks))).otherwise(blocks))


def excerpt(text: str, at: int, before: int = 400, after: int = 900) -> str:
    """A readable excerpt around a place: from a sentence start or word, to a word, marked where cut. Plain Python, for use in UDFs."""
    lo, hi = max(0, at - before), min(len(text), at + after)
    piece = text[lo:hi]
    if lo:
        start = _re.search(r"[.;]\s+(?=[A-Z(“\"])", piece[: at - lo])
        if start:
            piece = piece[start.end() :]
        else:
            word = piece.find(" ")
            piece = "… " + (piece[word + 1 :] if 0 <= word < 60 else piece).lstrip()
    if hi < len(text):
        piece = piece[: piece.rfind(" ")] if " " in piece else piece
        piece = piece.rstrip(" ,;:-") + "…"
    return piece.strip()
