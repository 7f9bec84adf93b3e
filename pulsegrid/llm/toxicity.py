"""Toxicity by a weighted lexicon.

Texts are folded (lower case, look-alike letters and digits that stand for letters), then an
Aho-Corasick automaton finds lexicon entries at word starts. Their weights, except inside
exception phrases, are summed and divided by the length; a logistic curve makes a score of that and of
the sum, so that one weak hit in a short text is no certainty.
Entries, weights, exceptions and curve are learned from labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches
from pulsegrid.llm.decisions import labelled_sample
from pulsegrid.session import materialise

#: Labelled rows used for learning, about; the first by a hash of their id.
SAMPLE = 20_000
#: Entries and exception phrases of a model, at most: those with the strongest evidence.
ENTRIES, EXCEPTIONS = 5_000, 1_000
#: Letters of a word's beginning that may be an entry.
PREFIXES = range(4, 11)
#: Words added to every length, so that one hit in a tiny text is no certainty.
PADDING = 20

#: Letters of other scripts that look like Latin ones, and digits and signs used for letters.
LOOK_ALIKES = dict(
    zip(
        "аеорсухіјѕԁһӏ" "αεορυικντ",
        "aeopcyxijsdhl" "aeopuiknt",
        strict=True,
    )
)
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
BREAKS = "\t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|*#%&-_/"

_FOREIGN = str.maketrans(LOOK_ALIKES | {chr(0xFF41 + i): chr(97 + i) for i in range(26)})
_ASCII = str.maketrans(DIGITS | dict.fromkeys(BREAKS, " "))


class Model(NamedTuple):
    """Entries (' ' and a word's beginning) with weights, harmless phrases, and the score's curve."""

    entries: dict[str, float]
    exceptions: list[str]
    intercept: float
    slopes: tuple[float, float]


def fold(text: str) -> str:
    """Folded text, words set apart by blanks, with a blank at either end."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOREIGN)
    return f" {text.translate(_ASCII)} "


def _terms(text: str | None) -> list[str]:
    """Distinct word beginnings of a text; short words whole, closed by a blank."""
    out = set()
    for word in set(fold(text or "").split()):
        if len(word) < PREFIXES[0]:
            out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in PREFIXES if n <= len(word))
    return list(out)


class Matcher:
    """The automaton of a model."""

    def __init__(self, entries: dict[str, float], exceptions: list[str]):
        self.found = ahocorasick.Automaton()
        for phrase in {*entries, *exceptions}:
            self.found.add_word(phrase, (len(phrase), entries.get(phrase), phrase in exceptions))
        if entries:
            self.found.make_automaton()
        self.any = bool(entries)

    def hits(self, folded: str) -> dict[int, float]:
        """Place of each word with an entry: the weight of its heaviest entry."""
        out: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (length, weight, exception) in self.found.iter(folded) if self.any else ():
            start = end - length + 1
            if exception:
                harmless.append((start, end))
            if weight is not None:
                out[start] = max(weight, out.get(start, 0.0))
        if not harmless:
            return out
        # one sweep over places and phrases, both ascending: `upto` is the end of the phrases begun so far
        harmless.sort()
        kept, upto, i = {}, 0, 0
        for at in sorted(out):
            while i < len(harmless) and harmless[i][0] <= at:
                upto = max(upto, harmless[i][1])
                i += 1
            if at >= upto:
                kept[at] = out[at]
        return kept

    def evidence(self, text: str | None) -> tuple[float, float]:
        """Weighted hits by length and as they are, on logarithmic scales; 0 for null, empty and clean texts."""
        folded = fold(text or "")
        total = sum(self.hits(folded).values())
        return math.log1p(1000 * total / (folded.count(" ") + PADDING)), math.log1p(total)


def evidence(text: Column, entries: dict[str, float], exceptions: list[str]) -> Column:
    """`Matcher.evidence` of a text, as an array of two."""

    @arrow_udf("array<double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(entries, exceptions)
        for batch in batches:
            yield pa.array([matcher.evidence(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return found(text)


def _all_terms(text: Column) -> Column:
    @arrow_udf("array<string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_terms(t.as_py()) for t in batch], pa.list_(pa.string()))

    return found(text)


def _phrases(text: Column, entries: dict[str, float]) -> Column:
    """Pairs of words, one of which has an entry."""

    @arrow_udf("array<string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(entries, [])
        for batch in batches:
            rows = []
            for text in batch:
                folded = " " + " ".join(fold(text.as_py() or "").split()) + " "
                pairs = set()
                for at in matcher.hits(folded):
                    end = folded.find(" ", at + 1)
                    after = folded.find(" ", end + 1)
                    before = folded.rfind(" ", 0, at) if at else -1
                    if after > 0:
                        pairs.add(folded[at:after + 1])
                    if before >= 0:
                        pairs.add(folded[before:end + 1])
                rows.append(list(pairs))
            yield pa.array(rows, pa.list_(pa.string()))

    return found(text)


def _counts(sample: DataFrame, terms: Column) -> DataFrame:
    """Per term, the toxic and the clean rows that have it."""
    return sample.select(F.explode(terms).alias("term"), "toxic").groupBy("term").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )


def _curve(bins: list[tuple]) -> tuple[float, tuple[float, float]]:
    """Logistic curve through (evidence, evidence, toxic rows, clean rows), with a small ridge."""
    if not bins:
        return 0.0, (0.0, 0.0)
    x, y, t, c = (np.array(v, float) for v in zip(*bins, strict=True))
    facts = np.stack([np.ones_like(x), x, y], axis=1)
    beta = np.array([math.log((t.sum() + 0.5) / (c.sum() + 0.5)), 0.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(facts @ beta, -30, 30)))
        slope = facts.T @ (t - (t + c) * p) - 0.1 * beta
        curve = facts.T @ (facts * ((t + c) * p * (1 - p))[:, None]) + 0.1 * np.eye(3)
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), (float(beta[1]), float(beta[2]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn a model from `docs` (doc_id, text) and `labels` (doc_id, toxic 0 or 1).

    Rows whose label or id is null are left out; an id with several labels counts once, as the
    largest. An entry must be more frequent among toxic rows than chance allows for so many
    terms. With nothing to learn from, every score is the share of toxic labels, or 0.5.
    """
    known = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = labelled_sample(known, sample)
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = materialise(rows.select("text", "toxic"), "labelled")
    toxic, total = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    entries: dict[str, float] = {}
    exceptions: list[str] = []
    if 0 < toxic < total:
        terms = materialise(_counts(rows, _all_terms(F.col("text"))), "terms")
        share, many = toxic / total, F.col("t") + F.col("c")
        chance = F.lit(math.log(max(1, terms.count())) + 2)
        gain = F.col("t") * F.log(F.col("t") / (many * share)) + F.when(
            F.col("c") > 0, F.col("c") * F.log(F.col("c") / (many * (1 - share)))
        ).otherwise(0.0)
        weight = F.log((F.col("t") + 0.5) / toxic) - F.log((F.col("c") + 0.5) / (total - toxic))
        strong = terms.where((F.col("t") > 0) & (gain > chance) & (weight > 1.5))
        best = strong.orderBy(gain.desc(), "term").limit(ENTRIES)
        entries = {r[0]: r[1] for r in best.select("term", weight).collect()}
        pairs = _counts(rows, _phrases(F.col("text"), entries)).where("t = 0 and c >= 3")
        exceptions = [r[0] for r in pairs.orderBy(F.desc("c"), "term").limit(EXCEPTIONS).collect()]
    # at most some ten thousand bins: both scales are logarithms of bounded sums
    found = rows.select("toxic", evidence(F.col("text"), entries, exceptions).alias("e"))
    places = [(F.round(F.get("e", F.lit(i)) * 10) / 10).alias(f"e{i}") for i in (0, 1)]
    bins = found.groupBy(*places).agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).collect()
    return Model(entries, exceptions, *_curve([tuple(b) for b in bins]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `score` (0 to 1) and `predicted` for every row of `docs`; other columns are ignored.

    Null and empty texts have no evidence and get the score of a clean text.
    """
    small_batches(docs.sparkSession)
    found = docs.select("doc_id", evidence(F.col("text"), model.entries, model.exceptions).alias("e"))
    x = sum((F.get("e", F.lit(i)) * F.lit(s) for i, s in enumerate(model.slopes)), F.lit(model.intercept))
    scored = found.select("doc_id", (1 / (1 + F.exp(-x))).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's digits divisible by 5; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def scored_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), sample)
    found = score(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
