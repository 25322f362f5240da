"""Subject areas of documents.

One-versus-rest logistic regressions on hashed word one- and two-grams say of a sentence which subject it deals
with. Sentences carry no labels of their own: those of a labelled document are weak labels for its sentences, and
a document without labels gets weak labels from the section metadata of its filing (how often each subject goes
with that section among the labelled ones). Training alternates between the model and each sentence's share of its
document's subjects, so sentences that stand in documents of every subject end up with none. Thresholds are
calibrated for each subject on labelled documents held out.

A document belongs to a subject when at least ``LEAST`` of its sentences and at least one in ``SHARE`` deal with
it, otherwise to ``GENERAL``. Null, empty and blank texts have no subject.

The training documents are bounded by ``LABELLED`` and ``WEAK``; every document is scored, over its whole text.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tidemark.llm import linear
from tidemark.llm.lookalike import IGNORABLE
from tidemark.operators.sampling import by_hash
from tidemark.session import arrow

#: Characters of training documents sent to the driver, by the mean length of the corpus.
BYTES = 200_000_000
#: Documents to train on: with labels, and with section metadata only.
LABELLED, WEAK = 8_000, 8_000
LEAST, SHARE = 2, 6
GENERAL = "general"
REMEMBERED = 100_000
#: Share of its sentences that a document is taken to spend on its subjects, and of labels taken to be right.
ON_SUBJECT, RIGHT = 0.6, 0.9

_break = re.compile(rf"(?<=[.!?])[\s{IGNORABLE}]+(?=\S)|\n+")
_word = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*|0")
_three_words = re.compile(r"(?:[^\W\d_]{2,}[\W\d_]+(?:[^\W\d_][\W\d_]+)*){2}[^\W\d_]{2}")
_lower = re.compile(r"[a-zß-öø-ÿα-ωа-я]")
_number = re.compile(r"\d[\d.,]*\d|\d")
_month = re.compile(r"\b(january|february|march|april|may|june|july|august|september|october|november|december)\b")
_furniture = re.compile(r"^\W*(part [ivx]+|item \w[\w.]*|exhibit [\w.]+|note \w+\W+[\w ]{0,40}|dear \w+:?|page \w+ of \w+)\W*$", re.I)


def sentences(text: str | None) -> list[str]:
    """The sentences of a text in lower case, numbers and months masked; headings and other page furniture are none."""
    out = []
    for piece in _break.split(text or ""):
        piece = piece.strip()
        if _three_words.search(piece) and _lower.search(piece) and not (len(piece) < 80 and _furniture.match(piece)):
            out.append(_month.sub("m", _number.sub("0", piece.lower())))
    return out


def features(sentence: str) -> np.ndarray:
    words = _word.findall(sentence)
    return np.unique(linear.hashed([f"1 {w}" for w in words] + [f"2 {a} {b}" for a, b in zip(words, words[1:], strict=False)]))


@dataclass
class Model:
    codes: list[str]
    weights: np.ndarray  # features x subjects
    bias: np.ndarray
    cut: np.ndarray
    held_out: tuple[float, float] = (0.0, 0.0)

    def odds(self, sentence: str) -> np.ndarray:
        return self.weights[features(sentence)].sum(0) + self.bias

    def subject(self, sentence: str) -> int:
        """Position of the subject that a sentence deals with, or -1."""
        z = self.odds(sentence)
        k = int(np.argmax(z - self.cut))
        return k if z[k] > self.cut[k] else -1

    def subjects(self, text: str | None, known: dict[str, int]) -> list[str] | None:
        if text is None or not text.strip().strip("\u200b\ufeff "):
            return None
        counts = np.zeros(len(self.codes), np.int64)
        found = sentences(text)
        for s in found:
            k = known.get(s)
            if k is None:
                k = self.subject(s)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[s] = k
            if k >= 0:
                counts[k] += 1
        return rule(self.codes, counts, len(found))


def rule(codes: list[str], counts: np.ndarray, n: int) -> list[str]:
    return [codes[k] for k in np.flatnonzero((counts >= LEAST) & (counts * SHARE >= n))] or [GENERAL]


@dataclass
class Doc:
    text: str
    labels: frozenset[str]
    section: str | None


def _fit(docs: list[Doc], codes: list[str], turns: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    at = {c: k for k, c in enumerate(codes)}
    k_all = len(codes)
    by_section: dict[str | None, np.ndarray] = defaultdict(lambda: np.full(k_all, 0.5))
    for d in docs:
        for c in d.labels:
            if c in at:
                by_section[d.section][at[c]] += 1
    overall = sum(by_section.values(), np.full(k_all, 0.5))
    overall = overall / overall.sum()
    names: dict[str, int] = {}
    sid, prior, weight = [], [], []
    for d in docs:
        own = [at[c] for c in d.labels if c in at]
        if own:
            p = (1 - RIGHT) * overall
            p[own] += RIGHT / len(own)
            w = 1.0
        elif d.labels:
            p, w = (1 - RIGHT) * ON_SUBJECT * overall, 1.0
        else:
            s = by_section.get(d.section)
            p, w = ON_SUBJECT * (overall if s is None or d.section is None else 0.9 * s / s.sum() + 0.1 * overall), 0.3
        for s in sentences(d.text):
            sid.append(names.setdefault(s, len(names)))
            prior.append(p)
            weight.append(w)
    if not names:
        return np.zeros((1 << linear.BITS, k_all), np.float32), np.full(k_all, -5.0)
    sid_, prior_, weight_ = np.array(sid), np.array(prior), np.array(weight)
    rows = linear.Rows.of([features(s) for s in names])
    n = np.bincount(sid_, weight_, len(names))
    target = prior_
    none = np.maximum(1 - prior_.sum(1, keepdims=True), 0.35)
    fits = [linear.Trainer(rows, n) for _ in codes]
    for turn in range(turns):
        y = np.stack([np.bincount(sid_, target[:, k] * weight_, len(names)) / n for k in range(k_all)], 1)
        for k, f in enumerate(fits):
            f.step(y[:, k], steps if turn == 0 else steps // 3)
        if turn + 1 < turns:
            z = np.clip(np.stack([f.odds() for f in fits], 1), -12, 12)
            mean = np.clip((y * n[:, None]).sum(0) / n.sum(), 1e-4, 1 - 1e-4)
            share = prior_ * np.exp(z - np.log(mean / (1 - mean)))[sid_]
            target = share / (share.sum(1, keepdims=True) + none)
    models = [f.model() for f in fits]
    return np.stack([w for w, _ in models], 1), np.array([b for _, b in models])


def _calibrate(model: Model, docs: list[Doc]) -> None:
    """For each subject the threshold under which its documents are told best, the others' being held."""
    odds = [np.array([model.odds(s) for s in sentences(d.text)]).reshape(-1, len(model.codes)) for d in docs]

    def said(cut: np.ndarray) -> list[set[str]]:
        out = []
        for z in odds:
            best = np.argmax(z - cut, 1) if len(z) else np.zeros(0, int)
            hit = best[z[np.arange(len(z)), best] > cut[best]] if len(z) else best
            out.append(set(rule(model.codes, np.bincount(hit, minlength=len(model.codes)), len(z))))
        return out

    for k, code in enumerate(model.codes):
        scored = []
        for p in (0.3, 0.4, 0.5, 0.6, 0.7):
            cut = model.cut.copy()
            cut[k] = np.log(p / (1 - p))
            hits = [(code in s, code in d.labels) for s, d in zip(said(cut), docs, strict=True)]
            tp, fp, fn = (sum(h == want for h in hits) for want in ((True, True), (True, False), (False, True)))
            scored.append((2 * tp / max(2 * tp + fp + fn, 1), -abs(p - 0.45), cut[k]))
        model.cut[k] = max(scored)[2]
    final = said(model.cut)
    tp = sum(len(s & d.labels) for s, d in zip(final, docs, strict=True))
    model.held_out = (tp / max(sum(map(len, final)), 1), tp / max(sum(len(d.labels) for d in docs), 1))


def train(docs: list[Doc], codes: list[str], turns: int = 4, steps: int = 40, seed: int = 5) -> Model:
    """Fit without a fifth of the labelled documents, calibrate and measure on it, then fit on all. Without documents nothing has a subject."""
    codes = sorted(set(codes) - {GENERAL, None})
    labelled = [d for d in docs if d.labels]
    random.Random(seed).shuffle(labelled)
    fifth = labelled[: len(labelled) // 5]
    held = set(map(id, fifth))
    cut = np.full(len(codes), np.log(0.45 / 0.55))
    model = Model(codes, *_fit([d for d in docs if id(d) not in held], codes, turns, steps), cut)
    if len(fifth) >= 100:
        _calibrate(model, fifth)
    if fifth:
        model.weights, model.bias = _fit(docs, codes, turns, steps)
    return model


def training_documents(docs: DataFrame, labels: DataFrame, sections: DataFrame, codes: list[str], labelled: int = LABELLED, weak: int = WEAK) -> list[Doc]:
    """At most ``labelled`` and ``weak`` documents of lowest hash of their ids; fewer where the corpus' mean length would bring more than ``BYTES`` characters.

    ``docs`` is (doc_id, key, text), ``labels`` (doc_id, subject_code), ``sections`` (key, section). Labels of unknown
    documents and codes are left out.
    """
    known = labels.filter(F.col("subject_code").isin(codes) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.collect_set("subject_code").alias("codes"))
    filled = docs.filter("trim(text) <> ''").select("doc_id", "key", "text")
    size = filled.agg(F.count(F.lit(1)).alias("n"), F.avg(F.length("text")).alias("mean")).first()
    share = min(1.0, BYTES / max((labelled + weak) * (size["mean"] or 0), 1))
    labelled, weak = int(labelled * share), int(weak * share)
    # ids first, texts by id
    with_labels = filled.join(F.broadcast(by_hash(known, ["doc_id"], labelled, known.count())), "doc_id")
    without = by_hash(filled, ["doc_id"], weak, size["n"]).join(known, "doc_id", "left_anti").withColumn("codes", F.array().cast("array<string>"))
    taken = with_labels.unionByName(without).collect()
    keys = docs.sparkSession.createDataFrame([(k,) for k in sorted({r.key for r in taken if r.key is not None})], "key string")  # at most labelled + weak keys
    named = {r.key: r.section for r in sections.join(F.broadcast(keys), "key").groupBy("key").agg(F.max("section").alias("section")).collect()}
    return [Doc(r.text, frozenset(r.codes), named.get(r.key)) for r in sorted(taken, key=lambda r: r.doc_id)]


def subjects_of(text: Column | str, broadcast) -> Column:
    """array<string>: the subjects of a text; null for null, empty and blank texts."""

    @arrow(ArrayType(StringType()))
    def subjects(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, known = broadcast.value, {}
        for batch in batches:
            yield pa.array([model.subjects(v.as_py(), known) for v in batch], pa.list_(pa.string()))

    return subjects(text)


def assign(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, subject_code), a row for each subject of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**18 floats for each subject, whatever the corpus
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(subjects_of(text, shared)).alias("subject_code"))
