"""Passages of long texts: notes under a heading, item bodies, firm names. Arrow functions, as a span needs several looks at a text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.text import excerpt
from tidemark.session import arrow


def _by_value(text: Column | str, of: Callable[[str], str | None]) -> Column:
    @arrow(StringType())
    def apply(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else of(v) for v in values.to_pylist()], pa.string())

    return apply(text)


def is_heading(line: str) -> bool:
    line = line.strip()
    return 0 < len(line) <= 70 and line[-1] not in ",:;" and not line[0].islower()


def find_note(text: str, topic: str, must: str | None = None, least: int = 200, most: int = 4_000) -> str:
    """The first note under a heading that names ``topic``, up to the next numbered heading, long enough and holding ``must``."""
    for m in re.finditer(rf"(?im)^.*{topic}.*$", text):
        line = m.group()
        if not is_heading(line) or re.search(r"\.{4,}|\s\d+\s*$", line):
            continue  # running text, or a row of the table of contents
        body = text[m.end() : m.end() + most]
        end = re.search(r"(?m)^\s*(?:note\s+)?\d{1,2}\s*[.:–—-]\s+[A-Z]", body)
        body = body[: end.start()] if end else body
        if len(body) >= least and (must is None or re.search(must, body, re.I)):
            return body.strip()
    return ""


def note_under(text: Column | str, topic: str, must: str | None = None, least: int = 200, most: int = 4_000) -> Column:
    return _by_value(text, lambda v: find_note(v, topic, must, least, most))


def find_item(text: str, code: str) -> str:
    """The longest passage headed by an item code, up to the next item or the signatures; the whole text without one."""
    best = ""
    for m in re.finditer(rf"(?i)\bitem\s+{re.escape(code)}\b", text):
        rest = text[m.end() :]
        end = re.search(r"(?i)\bitem\s+\d{1,2}\.\d{2}\b|\bsignatures?\b", rest)
        piece = rest[: end.start()] if end else rest
        best = max(best, piece.strip(), key=len)
    return best or text


def item_body(text: Column | str, code: str) -> Column:
    return _by_value(text, lambda v: find_item(v, code))


def around(text: Column | str, pattern: str, before: int = 400, after: int = 900) -> Column:
    """A readable excerpt around the first match; null without one."""
    seek = re.compile(pattern, re.I)

    def of(v: str) -> str | None:
        m = seek.search(v)
        return excerpt(v, m.start(), before, after) if m else None

    return _by_value(text, of)


def compatible(text: Column | str) -> Column:
    """Compatibility composition (NFKC): there is no built-in."""
    return _by_value(text, lambda v: v if v.isascii() else unicodedata.normalize("NFKC", v))


_FIRM = r"((?:[A-Z][\w.'’-]*|&|and|of)(?:,?\s+(?:[A-Z][\w.'’-]*|&|and|of)){0,7}?,?\s+(?:LLP|L\.L\.P\.|LLC|PLLC|P\.?C\.?|CPAs?|& Co\.?|Chartered)\b\.?)"
_NOT_AUDITOR = re.compile(r"(?i)\b(?:counsel|law\s+firm|attorneys?|underwriters?)\b")


def firm_after(text: str, verb: str, issuer: str = "") -> str:
    """The accounting firm named behind a verb; no law firm, no underwriter, not the issuer itself."""
    for m in re.finditer(rf"(?:{verb})[^.;]{{0,120}}?\b{_FIRM}", text):
        name = re.sub(r"(?<=[A-Za-z]{3})\.$", "", m.group(1).strip(" ,"))  # the sentence's stop, not a legal form's
        tail = text[m.end() : m.end() + 80]
        if len(name) >= 4 and not _NOT_AUDITOR.search(tail) and name.lower().strip(".") not in issuer.lower():
            return name
    return ""


def outgoing_firm(text: Column | str) -> Column:
    return _by_value(text, lambda v: firm_after(v, r"dismiss(?:ed|al of)|resignation of|terminat(?:ed|ion of) the engagement of|advised by|ended the engagement of"))


def incoming_firm(text: Column | str) -> Column:
    return _by_value(text, lambda v: firm_after(v, r"engaged|appointed|retained|selected|engagement of(?! its)"))


_RISK = r"(?im)^\W*(?:item\s+1a\W+)?risk\s+factors\W*$"
_NEXT_ITEM = r"(?im)^\W*item\s+\d+[a-c]?\b"


def without_risk_factors(text: str) -> tuple[str, str]:
    """(the text without its risk factors, the risk factors)."""
    m = re.search(_RISK, text)
    if not m:
        return text, ""
    end = re.search(_NEXT_ITEM, text[m.end() : m.end() + 250_000])
    stop = m.end() + (end.start() if end else min(len(text) - m.end(), 250_000))
    return text[: m.start()] + text[stop:], text[m.end() : stop]


def concern_passage(text: Column | str) -> Column:
    """The passage that a going-concern reading should use: the note, else the text without risk factors where it speaks of doubt, else "risk" before the risk factors that do."""
    speaks = re.compile(r"(?i)substantial\s+doubt[^.!?;]{0,200}?(?:going\s+concern|ability\s+to\s+continue)|(?:going\s+concern|ability\s+to\s+continue)[^.!?;]{0,200}?substantial\s+doubt")

    def of(v: str) -> str:
        note = find_note(v, "going concern", r"substantial\s+doubt|going\s+concern")
        if note:
            return note
        body, risk = without_risk_factors(v)
        if speaks.search(body):
            return body
        return "\u0000risk" if speaks.search(risk) else ""

    return _by_value(text, of)


def concern_of(passage: Column) -> Column:
    """The going-concern state that a ``concern_passage`` gives."""
    from tidemark.detect.conclusions import going_concern

    return F.when(passage == "\u0000risk", "risk_factor_only").otherwise(going_concern(passage))


def document_concern(text: Column) -> Column:
    """The going-concern state of a whole document; risk_factor_only where nothing but the risk factors speak of it."""
    return concern_of(concern_passage(text))


#: Characters of a revenue note at most.
LONGEST_NOTE = 20_000


def revenue_note(text: Column | str) -> Column:
    """The revenue policy note: of the notes under a revenue heading, outside the discussion and the audit report, the one with most marks."""
    from tidemark.detect.conclusions import REVENUE_MARKERS

    marks = [re.compile(m, re.I) for m in REVENUE_MARKERS]

    def of(v: str) -> str:
        best, score = "", (2, 0)
        shut = [m.span() for p, n in ((r"Management[\u2019']s\s+Discussion\s+and\s+Analysis", 80_000), (r"Report\s+of\s+Independent\s+Registered", 25_000)) for m in re.finditer(rf"(?is)^{p}.{{0,{n}}}?(?=^\s*item\s+\d|\Z)", v, re.M)]
        for m in re.finditer(r"(?im)^.*revenue\s+(?:from\s+contracts|recognition).*$|^.*disaggregation\s+of\s+revenue.*$", v):
            if not is_heading(m.group()) or any(a <= m.start() < b for a, b in shut):
                continue
            body = v[m.end() : m.end() + LONGEST_NOTE]
            end = re.search(r"(?m)^\s*(?:note\s+)?\d{1,2}\s*[.:\u2013\u2014-]\s+[A-Z]", body)
            body = (body[: end.start()] if end else body).strip()
            got = (sum(bool(k.search(body)) for k in marks), len(body))
            if len(body) >= 400 and got > score and got[0] >= 3:
                best, score = body, got
        return best

    return _by_value(text, of)


_CONTROLS = re.compile(r"(?im)^\W*(?:item\s+\d+[a-c]?\W+)?(?:disclosure\s+)?controls\s+and\s+procedures\W*$")
_JUDGED = re.compile(r"(?i)internal\s+controls?\s+over\s+financial\s+reporting[^.;]{0,160}?\b(?:in)?effective\b|\bnot\s+effective\b")
#: Characters of a passage on controls at most.
LONGEST_CONTROLS = 30_000


def controls_in(text: str) -> str:
    """The last passage under a heading on controls that judges them, to the next item; without such headings the text less its risk factors."""
    heads = list(_CONTROLS.finditer(text))
    for m in reversed(heads):
        scope = text[m.end() : m.end() + LONGEST_CONTROLS]
        end = re.search(_NEXT_ITEM, scope)
        scope = scope[: end.start()] if end else scope
        if _JUDGED.search(scope):
            return scope
    return "" if heads else without_risk_factors(text)[0]


def document_control(text: Column | str) -> Column:
    """The internal-control state of a whole document; empty where none is stated."""
    from tidemark.detect.conclusions import control_state

    return control_state(_by_value(text, controls_in))
