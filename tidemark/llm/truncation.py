"""Texts that were cut off before their end.

Intact values are cut artificially to make positives, at any character, with the remains of a transfer behind the
cut or nothing; the intact values themselves, with blanks, invisible characters or footnote marks behind them, are
the negatives. A logistic regression on hashed features of the closing characters and words, the punctuation and
the length against the field's limits is trained on them, its threshold set on values held out, and every record
is scored. Null, blank and invisible values are not cut.

The training sample is bounded by ``SAMPLE`` distinct values of each field; the lengths and all scores cover all rows.
What is counted and sampled are hashes; only the texts that are taken travel.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm import linear
from tidemark.llm.lookalike import IGNORABLE
from tidemark.session import arrow, land

#: Distinct values of each field to train on.
SAMPLE = 8_000
CUTS = 3
#: What transfers and field limits leave behind a cut.
REMAINS = ["", "", "", "", "…", " …", "...", " ...", " [cont", "[...]", "&am", "&nbs", "</p>", "<br", "�", '"', ")", "”", " ", "  ", "\n"]
#: What may stand behind a whole sentence.
MARKS = ["", "", "", " ", "  ", "\n", "\u200b", "\ufeff", "\xa0", "¹", "²", "*", " †", "†", "[2]", " [3]", " (1)", "\u2060 "]

_trail = re.compile(rf"[\s{IGNORABLE}]+$")
_note = re.compile(r"(?<=[.?!”\"')’»])\s*(?:\[\d{1,3}\]|\(\d{1,3}\)|[*†‡§¶]{1,3}|[¹²³⁰⁴-⁹]{1,3})$")
_sentence = re.compile(r"(?<=[.?!”)])\s+(?=[A-ZÀ-ÞΑ-ΩА-Я“«(])")
_whole = re.compile(r"(?<![.…])[.?!][”\"')’»]*$")
_zero = re.compile(f"[{IGNORABLE}]+")
_digits = re.compile(r"\d[\d.,]*\d|\d")


def closing(value: str) -> str:
    """The value without blanks, invisible characters and footnote marks behind its end."""
    text = _trail.sub("", value)
    while (less := _trail.sub("", _note.sub("", text))) != text:
        text = less
    return _zero.sub("", text)


def heading(text: str) -> bool:
    """A short line of capitalised words without a sentence's end."""
    words = re.findall(r"[^\W\d_]+", text)
    return bool(words) and len(text) <= 80 and text[-1].isalnum() and "," not in text and words[-1][0].isupper() and all(w[0].isupper() for w in words if len(w) > 3)


def _kind(ch: str) -> str:
    return "a" if ch.islower() else "A" if ch.isupper() else "0" if ch.isdigit() else "_" if ch.isspace() else ch


def features(value: str, limits: frozenset[int]) -> list[str]:
    text = closing(value)
    tail = _digits.sub("0", text[-160:])
    last = _sentence.split(tail)[-1]
    words = last.split()
    whole = "W" if _whole.search(text) else "-"
    kinds = "".join(map(_kind, tail[-4:]))
    lower = sum(w[0].islower() for w in words)
    open_ = ("“" if text.count("“") > text.count("”") else "") + ("(" if text.count("(") > text.count(")") else "")
    short = lambda w: w if len(w) <= 24 else w[-24:]
    out = [f"end{n}={tail[-n:]}" for n in (1, 2, 3, 4, 6, 9)] + [f"kind{n}={kinds[-n:]}" for n in (1, 2, 3, 4)]
    out += [f"word{n}={' '.join(map(short, words[-n:])).lower()}" for n in (1, 2, 3, 4)]
    out += [f"whole={whole}", f"open={open_}{whole}", f"words={min(len(words), 6)}{whole}", f"lower={min(lower, 3)}{whole}", f"capital={bool(words) and words[-1][:1].isupper()}{whole}"]
    out += [f"heading={heading(text)}", f"limit={len(value) in limits}{whole}", f"round={len(value) % 50 == 0 or len(value) in (255, 256)}{whole}"]
    if len(text) <= 80:
        out.append(f"all={_digits.sub('0', text)}")
    return out


def length_limits(lengths: dict[int, tuple[int, int]]) -> frozenset[int]:
    """Lengths at which a field cuts: of the different values, more than at the twenty lengths around, and most without a whole ending.

    ``lengths`` gives for each length the number of different values and of those among them that do not end a sentence.
    """
    out = set()
    for n, (k, open_) in lengths.items():
        around = sum(lengths.get(m, (0, 0))[0] for m in range(n - 10, n + 11) if m != n)
        if n >= 80 and k >= 20 and k > 2 * (around / 20 + 1) and open_ >= 0.6 * k:
            out.add(n)
    return frozenset(out)


def _continues(values: list[str]) -> set[str]:
    """Last words that look like a sentence's end and are not: after them the text nearly always goes on."""
    on, all_ = Counter(), Counter()
    for v in values:
        words = v.split()
        for a, b in zip(words, [*words[1:], ""], strict=True):
            if a.endswith("."):
                all_[a.lower()] += 1
                on[a.lower()] += bool(b) and not b[0].isupper()
    return {w for w, n in all_.items() if n >= 5 and on[w] >= 0.9 * n}


def _examples(values: list[str], counts: dict[str, int], abbreviations: set[str], limits: frozenset[int], seed: int) -> list[tuple[str, int, float]]:
    """(value, cut, weight). A value weighs more the oftener it stands: what many rows end with is no accident."""
    rng = random.Random(seed)
    out: list[tuple[str, int, float]] = []
    for v in values:
        text = closing(v)
        words = text.split()
        if not words or not (_whole.search(text) and words[-1].lower() not in abbreviations) and not heading(text):
            continue
        weight = min(counts.get(v, 1), 400) ** 0.5
        out.append((v, 0, weight))
        if not heading(text):
            out.append((text + rng.choice(MARKS), 0, 1.0))
            out += [(s, 0, 0.5) for s in _sentence.split(text)[:1] if _whole.search(s) and s.split()[-1].lower() not in abbreviations]
        spaces = [m.start() for m in re.finditer(r"\s", text)]
        for _ in range(CUTS):
            at = rng.choice(spaces) if spaces and rng.random() < 0.4 else rng.randrange(1, max(2, len(text)))
            at_limit = [n for n in sorted(limits) if n < len(text)]
            if at_limit and rng.random() < 0.2:
                at = rng.choice(at_limit)  # a field's limit leaves nothing behind the cut
            cut = text[:at]
            rest = text[at:].strip("”\"')’» ")
            end = cut.rstrip()
            if not end or not rest or heading(end) and not heading(text) and len(end.split()) < 2:
                continue
            if _whole.search(end) and end.split()[-1].lower() not in abbreviations and (text[at : at + 1].isspace() or cut != end):
                continue  # the cut fell between two sentences
            out.append((cut if at in limits else cut + rng.choice(REMAINS), 1, 1.0))
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    limits: frozenset[int]
    held_out: tuple[float, float]

    def score(self, value: str) -> float:
        if not closing(value):
            return -1.0
        z = float(self.weights[linear.hashed(features(value, self.limits))].sum()) + self.bias
        return z


def train(counts: dict[str, int], lengths: dict[int, tuple[int, int]], seed: int = 7) -> Model:
    """Fit on four fifths of the values (with the rows that hold each); precision, recall and threshold come from the rest, which then train too."""
    limits = length_limits(lengths)
    values = sorted(counts)
    random.Random(seed).shuffle(values)
    fifth = len(values) // 5
    abbreviations = _continues(values)
    made, kept = (_examples(part, counts, abbreviations, limits, seed + i) for i, part in enumerate((values[fifth:], values[:fifth])))
    if not any(y for _, y, _ in made):
        return Model(np.zeros(1 << linear.BITS, np.float32), -1.0, limits, (0.0, 0.0))
    w, b = _fit(made, limits)
    held_out, shift = (0.0, 0.0), 0.0
    if kept:
        z = linear.Rows.of([linear.hashed(features(e[0], limits)) for e in kept]).sums(w) + b
        truth = np.array([e[1] for e in kept]) > 0
        shift = float(max(np.linspace(-3, 3, 61), key=lambda t: (((z > t) == truth).mean(), -abs(t))))
        said = z > shift
        held_out = (float((said & truth).sum() / max(said.sum(), 1)), float((said & truth).sum() / max(truth.sum(), 1)))
        w, b = _fit(made + kept, limits)  # the values held out have set the threshold and now train too
    return Model(w, b - shift, limits, held_out)


def _fit(made: list[tuple[str, int, float]], limits: frozenset[int]) -> tuple[np.ndarray, float]:
    y, weight = np.array([e[1] for e in made], float), np.array([e[2] for e in made])
    for label in (0, 1):
        weight[y == label] /= 2 * max(weight[y == label].sum(), 1e-9)
    return linear.fit(linear.Rows.of([linear.hashed(features(e[0], limits)) for e in made]), y, weight, steps=120)


def train_on(rows: DataFrame, field: str, value: str, sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` distinct values of each field: half those of most rows, the others those of lowest hash."""
    filled = rows.filter(F.trim(value) != "").select(F.col(field).alias("f"), F.col(value).alias("v"), F.xxhash64(value).alias("h"))
    ends = F.col("v").rlike("[.?!][”\"')’»]*\\s*$")
    hashes = land(filled.groupBy("f", "h").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("v")).alias("length"), F.bool_or(ends).alias("ends")), "hashes")
    sizes = hashes.groupBy("f").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).orderBy("f").collect()  # a row for each field
    picked: dict[tuple[str, int], int] = {}
    for size in sizes:
        own = hashes.filter(F.col("f").eqNullSafe(F.lit(size.f))).select("h", "n")
        # values in a millionth of the rows or more are a million at most; of the others a sample by a threshold on the hash
        frequent = own.filter(F.col("n") >= max(2, size.n // 1_000_000)).orderBy(F.desc("n"), "h").limit(sample // 2)
        thin = min(1.0, (0.6 * sample + 100) / max(size.k, 1))
        others = own.filter(F.pmod("h", F.lit(1 << 30)) < int(thin * (1 << 30)) + (thin >= 1.0)).orderBy("h").limit(sample // 2)
        picked.update({(size.f, r.h): r.n for r in frequent.unionByName(others).collect()})
    counts: Counter[str] = Counter()
    if picked:
        taken = rows.sparkSession.createDataFrame(list(picked), "f string, h long")  # ``sample`` rows a field at most
        for r in filled.join(F.broadcast(taken), ["f", "h"]).groupBy("f", "h").agg(F.min("v").alias("v")).collect():
            counts[r.v] = max(counts[r.v], picked[r.f, r.h])
    by_length = hashes.groupBy("length").agg(F.count(F.lit(1)).alias("k"), F.count_if(~F.col("ends")).alias("open"))
    lengths = {r.length: (r.k, r.open) for r in by_length.collect()}  # no more than the longest value has characters
    return train(counts, lengths)


def cut_score(value: Column | str, broadcast) -> Column:
    """double: over 0 for a cut value, under 0 for an intact one; null for null."""
    @arrow(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = broadcast.value.score
        for batch in batches:
            coded = batch.dictionary_encode()
            yield pa.array([None if v is None else of(v) for v in coded.dictionary.to_pylist()], pa.float64()).take(coded.indices)

    return score(value)


def find_cut(rows: DataFrame, field: str, value: str, model: Model | None = None) -> DataFrame:
    """The rows with ``score`` and ``cut``; the model is trained on the rows where none is given.

    ``rows`` holds one value a row, ``field`` names where it stands. Null and blank values score below 0 and are
    not cut; an empty table gives no row.
    """
    model = model or train_on(rows, field, value)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # 2**18 floats, whatever the rows
    scored = rows.withColumn("score", cut_score(value, shared))
    return scored.withColumn("cut", F.coalesce(F.col("score") > 0, F.lit(False)))
