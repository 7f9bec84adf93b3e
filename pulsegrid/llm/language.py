"""Language identification by Bayesian fusion of evidence.

The likelihood of a text's letter trigrams under each language is combined with what its markup
declares, its address's suffix and its host's prior. Priors of hosts are smoothed towards those of
their parents, and the reliability of declarations and suffixes is measured, all by grouped sums of
text-only posteriors over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches
from pulsegrid.llm.decisions import content_key, with_verdicts
from pulsegrid.operators.joins import attach
from pulsegrid.session import materialise

#: Labelled texts per language from which trigrams are learned, about; chosen by a hash of their id.
SAMPLE = 4_000
#: Languages whose counts a task holds together.
HELD = 128
#: Cells for trigrams.
CELLS = 1 << 15
#: Neighbouring trigrams share letters: what one counts as evidence.
WEIGHT = 1 / 3
#: Rows that a parent's distribution counts as, in a host's.
PRIOR_ROWS = 20.0
#: Share of rows in no known language, before any evidence.
UNKNOWN, UNKNOWN_SHARE = "und", 0.001
#: Posterior below which a row is rejected.
LEAST_POSTERIOR = 0.5
#: Letters whose trigrams are counted together.
CHUNK = 1 << 20

_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # log-probability of cells, [language][cell], float32


def _cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the letter trigrams of texts, and where each text's begin.

    Letters are in lower case, anything else is a blank; trigrams with two blanks side by side are
    left out. Every text yields one cell more than its trigrams, CELLS, which weighs nothing.
    """
    symbols = np.frombuffer("".join(f" {t.lower()} \0" for t in texts).encode("utf-32-le"), np.uint32)
    known = symbols < 0x3000
    letter = ~known
    letter[known] = _LETTER[symbols[known]]
    end = symbols == 0
    s = np.where(letter, symbols, np.uint32(32))
    a, b, c = s[:-2], s[1:-1], s[2:]
    cell = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))) >> np.uint32(17)
    blank = ~letter
    none = (blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]) | end[:-2] | end[1:-1] | end[2:]
    keep = ~none | end[2:]
    cell[end[2:]] = CELLS
    text_of = np.append(0, np.cumsum(end[2:][keep])[:-1])
    return cell[keep], np.searchsorted(text_of, np.arange(len(texts)))


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append((text.as_py() or "").replace("\0", " "))
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def declared_language(value: Column) -> Column:
    """The main part of a language tag in lower case ('en' of 'en-US'), or null; 'und' declares nothing."""
    tag = F.regexp_extract(F.lower(value), r"^\s*([a-z]{2,3})\b", 1)
    return F.when(~tag.isin("", UNKNOWN), tag)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trigram model of every language that `docs` (doc_id, text, lang) are labelled with.

    About `sample` texts a language are read, or all it has. Null labels and texts are left out, and
    languages without a letter in them; with no labels the model has no languages.
    """
    small_batches(docs.sparkSession)
    tagged = docs.select("doc_id", "text", declared_language(F.col("lang")).alias("lang")).dropna(subset=["text", "lang"])
    # tags have two or three letters: so many rows at most
    counts = {r["lang"]: r["count"] for r in tagged.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, CELLS + 1), np.float32))
    place = {language: i for i, language in enumerate(languages)}
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20))
    shares = [math.ceil((1 << 20) * min(1, sample / counts[x])) for x in languages]
    share = F.element_at(F.map_from_arrays(F.lit(languages), F.lit(shares)), F.col("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}

        def held() -> Iterator[pa.RecordBatch]:
            for language, total in totals.items():
                cell = np.flatnonzero(total)
                columns = (np.full(len(cell), language, np.int32), cell.astype(np.int32), total[cell])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["language", "cell", "n"])
            totals.clear()

        for batch in batches:
            tags = iter(batch.column("lang").to_pylist())
            for texts in _chunks(batch.column("text")):
                cells, begins = _cells(texts)
                ends = np.append(begins[1:], len(cells))
                for lo, hi in zip(begins, ends, strict=True):
                    language = place[next(tags)]
                    if language not in totals:
                        if len(totals) == HELD:
                            yield from held()
                        totals[language] = np.zeros(CELLS + 1, np.int64)
                    totals[language] += np.bincount(cells[lo:hi], minlength=CELLS + 1)
        yield from held()

    rows = tagged.where(chance < share).select("text", "lang").mapInArrow(count, "language int, cell int, n long")
    # at most languages x cells rows
    sums = rows.where(F.col("cell") < CELLS).groupBy("language", "cell").agg(F.sum("n").alias("n")).toArrow()
    language, cell, n = (sums.column(c).to_numpy() for c in ("language", "cell", "n"))
    known, row = np.unique(language, return_inverse=True)
    table = np.zeros((len(known), CELLS + 1), np.float32)
    for i in range(len(known)):
        seen = np.zeros(CELLS)
        seen[cell[row == i]] = n[row == i]
        table[i, :CELLS] = np.log((seen + 0.1) / (seen.sum() + 0.1 * CELLS))
    return Model([languages[i] for i in known], table)


def likelihoods(text: Column, model: Model) -> Column:
    """Weighted log-likelihood of a text under each language, and at the end under none (any cell alike).

    A null text, or one without letters, has 0 everywhere: no evidence.
    """

    @arrow_udf("array<double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = [*model.table, np.append(np.full(CELLS, -math.log(CELLS)), 0.0)]
        for batch in batches:
            parts = []
            for texts in _chunks(batch):
                cells, begins = _cells(texts)
                parts.append(WEIGHT * np.stack([np.add.reduceat(t[cells], begins, dtype=np.float64) for t in tables], axis=1))
            rows = np.concatenate(parts) if parts else np.zeros((0, len(tables)))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * len(tables)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))

    return found(text)


def _softmax(logs: Column) -> Column:
    shares = F.transform(F.array(logs), lambda xs: F.transform(xs, lambda x: F.exp(x - F.array_max(xs))))
    return F.get(
        F.transform(shares, lambda es: F.transform(es, lambda e: e / F.aggregate(es, F.lit(0.0), lambda a, x: a + x))), F.lit(0)
    )


def _sums(count: int) -> Column:
    """Sums of the text-only posterior `p`, as an array."""
    return F.array(*(F.sum(F.get("p", F.lit(i))) for i in range(count)))


def _reliability(rows: DataFrame, column: str, count: int) -> DataFrame:
    """Per value of a column, log of how likely each language's rows carry it."""
    by = rows.where(F.col(column).isNotNull()).groupBy(column).agg(_sums(count).alias("n"))
    whole = by.agg(*(F.sum(F.get("n", F.lit(i))).alias(f"t{i}") for i in range(count)), F.count("*").alias("values")).first()
    totals = F.lit([float(whole[f"t{i}"] or 0.0) for i in range(count)])
    # with a little for every language, so that no declaration is ever proof
    log = F.zip_with("n", totals, lambda n, t: F.log((n + 0.5) / (t + 0.5 * (whole["values"] + 1))))
    return by.select(column, log.alias(f"{column}_log"))


def identify(rows: DataFrame, model: Model, hosts: list[str], evidence: list[str]) -> DataFrame:
    """Posterior languages of `rows`: `id`, `text`, columns of `evidence`, and `hosts` from the widest to the narrowest.

    One row per row: `id`, the evidence, `language`, `posterior`, `kept`. A row is rejected if no language reaches
    half of the posterior, or if its text is in none of the known ones or has no letter. A row with letters whose
    `declared` language has no model keeps that language; its posterior is null. Null
    evidence says nothing, a null host has its parent's prior. Equal ids keep their rows.
    """
    small_batches(rows.sparkSession)
    languages = [*model.languages, UNKNOWN]
    count = len(languages)
    first = [math.log((1 - UNKNOWN_SHARE) / max(1, count - 1))] * (count - 1) + [math.log(UNKNOWN_SHARE)]
    logs = F.zip_with("text_log", F.lit(first), lambda a, b: a + b)
    scored = rows.select("id", *hosts, *evidence, likelihoods(F.col("text"), model).alias("text_log"))
    scored = materialise(scored.withColumn("p", _softmax(logs)), "likelihoods")
    whole = scored.agg(*(F.sum(F.get("p", F.lit(i))).alias(f"t{i}") for i in range(count))).first()
    sums = [float(x or 0.0) + 0.5 for x in whole]
    prior = F.lit([x / sum(sums) for x in sums])
    found = scored.withColumn("prior", prior)
    for host in hosts:
        own = scored.where(F.col(host).isNotNull()).groupBy(host).agg(_sums(count).alias(f"{host}_n"))
        found = attach(found, own, [host], spread_by=["id"])
        rows_of = F.aggregate(f"{host}_n", F.lit(0.0), lambda a, x: a + x)
        mixed = F.zip_with(f"{host}_n", "prior", lambda n, p: (n + PRIOR_ROWS * p) / (rows_of + PRIOR_ROWS))
        found = found.withColumn("prior", F.coalesce(mixed, F.col("prior"))).drop(f"{host}_n")
    total = F.zip_with("text_log", "prior", lambda a, b: a + F.log(b))
    for column in evidence:
        found = attach(found, _reliability(scored, column, count), [column], spread_by=["id"])
        total = F.zip_with(total, F.coalesce(f"{column}_log", F.lit([0.0] * count)), lambda a, b: a + b)
    found = found.select("id", *evidence, "text_log", _softmax(total).alias("post"))
    best = F.array_max("post")
    language = F.get(F.lit(languages), F.array_position("post", best).cast("int") - 1)
    spoken = F.exists("text_log", lambda x: x != 0)
    other = F.lit(False)
    if "declared" in evidence:
        other = spoken & F.col("declared").isNotNull() & ~F.array_contains(F.lit(languages), F.coalesce("declared", F.lit("")))
    return found.select(
        "id",
        *evidence,
        (F.when(other, F.col("declared")).otherwise(language) if "declared" in evidence else language).alias("language"),
        F.when(~other, best).alias("posterior"),
        (other | (spoken & (language != UNKNOWN) & (best >= LEAST_POSTERIOR))).alias("kept"),
    )


def _documents(docs: DataFrame, key: Column, sample: int) -> DataFrame:
    declared = declared_language(F.col("lang")).alias("declared")
    rows = docs.select(key.alias("id"), "text", F.col("source").alias("host"), declared)
    return identify(rows, fit(docs, sample), ["host"], ["declared"])


def document_languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`doc_id`, `language`, `posterior`, `kept` of documents: `lang` is their declared language, `source` their host."""
    return _documents(docs, F.col("doc_id"), sample).withColumnRenamed("id", "doc_id").drop("declared")


def identified_documents(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are kept, all columns, with `lang` corrected to the language found."""
    found = _documents(docs, content_key(docs), sample)
    odd = found.where(~F.col("kept") | ~F.col("language").eqNullSafe(F.col("declared")))
    verdicts = odd.select(F.col("id").alias("key"), F.col("kept").alias("_kept"), F.col("language").alias("_language")).distinct()
    rows = with_verdicts(docs, verdicts).where(F.coalesce("_kept", F.lit(True)))
    return rows.withColumn("lang", F.coalesce("_language", "lang")).select(docs.columns)


def page_languages(pages: DataFrame, model: Model) -> DataFrame:
    """`page_id`, `language`, `posterior`, `kept` of web pages (page_id, url, html).

    The text is what stands outside of tags; the declaration is the html tag's, the address's evidence
    its language segment or else its top-level domain, its hosts the registered domain and the host.
    """
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)), F.lit(""))
    segment = F.regexp_extract("url", r"^[a-zA-Z]+://[^/]+/([a-z]{2})(?:/|$)", 1)
    rows = pages.select(
        F.col("page_id").alias("id"),
        F.regexp_replace(text, r"&[#\w]{1,10};", " ").alias("text"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        host.alias("host"),
        declared_language(F.regexp_extract(html, r"(?i)<html[^>]*?\blang=[\"']?([a-zA-Z-]+)", 1)).alias("declared"),
        F.when(segment != "", segment).otherwise(F.regexp_extract(host, r"([^.]+)$", 1)).alias("suffix"),
    )
    found = identify(rows, model, ["domain", "host"], ["declared", "suffix"])
    return found.withColumnRenamed("id", "page_id").drop("declared", "suffix")
