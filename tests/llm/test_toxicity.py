from __future__ import annotations

import random
import time
import zlib

import pytest
from rows import ODD, documents, no_documents, odd_documents

from pulsegrid.llm import toxicity
from pulsegrid.llm.queries import op5

CLEAN = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def corpus(spark, n: int = 400):
    chance = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        words = chance.choices(CLEAN, k=chance.randint(5, 80))
        toxic = i % 8 == 0
        for _ in range(3 if toxic else 0):
            words.insert(chance.randrange(len(words)), chance.choice(["grumpole", "Grump0le!", "snarvling", "ѕnarvling"]))
        if i % 8 == 1:
            words.insert(chance.randrange(len(words)), "snarvling beetle")
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_folding():
    assert toxicity.fold("Іd1ot, ｍоrοn") == " idiot  moron "
    assert toxicity.fold("") == "  "


def test_entries_exceptions_and_weights():
    found = toxicity.Matcher({" snarv": 2.0, " snarvling": 3.0, " odd ": 1.0}, [" snarvling beetle "])
    assert found.hits(toxicity.fold("a Snarvling, a snarv5! odd oddly unsnarv")) == {2: 3.0, 15: 2.0, 23: 1.0}
    assert found.hits(toxicity.fold("the snarvling beetle and a snarvling")) == {27: 3.0}
    short, long = found.evidence("snarvling here"), found.evidence("snarvling here" + " word" * 500)
    assert 0 < long[0] < short[0] and long[1] == short[1]
    assert found.evidence(None) == found.evidence("") == (0.0, 0.0)


def test_learns_words_and_their_exceptions(spark):
    docs, labels, toxic = corpus(spark)
    rows = toxicity.scored_documents(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == toxic[r.doc_id] == (r.score >= 0.5) for r in held)


def test_held_out_rows_teach_nothing(spark):
    docs, labels, _ = corpus(spark)
    turned = labels.withColumn("toxic", toxicity.held_out(labels.doc_id).cast("int"))
    mixed = labels.where(~toxicity.held_out(labels.doc_id)).unionByName(turned.where("toxic = 1"))
    score = lambda some: sorted(toxicity.scored_documents(docs, some).collect())
    assert score(labels) == score(mixed)


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op5(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels if rows[r.doc_id].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.9


def test_odd_rows(spark):
    _, labels, _ = corpus(spark)
    model = toxicity.fit(*corpus(spark)[:2])
    rows = toxicity.score(odd_documents(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    clean = 1 / (1 + 2.718281828459045 ** -model.intercept)
    assert [r.score for r in rows if r.doc_id in (1, 2, 3)] == pytest.approx([clean] * 3)
    none = labels.where("false")
    assert {r.score for r in toxicity.scored_documents(odd_documents(spark), none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1, "x"), (1, None, "x"), (4, 1, "x"), (4, 0, "x"), (6, 0, "x")], "doc_id long, toxic int, text string")
    assert toxicity.scored_documents(odd_documents(spark), odd).count() == len(ODD)
    assert toxicity.scored_documents(no_documents(spark), labels).count() == 0


def test_many_exceptions_and_hits():
    """One sweep gives what each exception by itself would take away, in proportion to the text."""
    chance = random.Random(5)
    entries, exceptions = {" bad": 1.0, " worse": 2.0, " a": 0.5}, [" not bad", " a bad", " worse luck a", " luck"]
    matcher = toxicity.Matcher(entries, exceptions)
    for _ in range(300):
        text = " " + " ".join(chance.choices(["bad", "worse", "not", "a", "luck", "fine"], k=chance.randint(0, 30))) + " "
        places = {text.find(p, i): max(w for q, w in entries.items() if text.startswith(q, text.find(p, i)))
                  for p in entries for i in range(len(text)) if text.find(p, i) >= 0}
        covered = {i for e in exceptions for s in range(len(text)) if text.startswith(e, s) for i in range(s, s + len(e))}
        assert matcher.hits(text) == {i: w for i, w in places.items() if i not in covered}
    start = time.perf_counter()
    assert matcher.hits(" not bad worse" * 40_000) == {i * 14 + 8: 2.0 for i in range(40_000)}
    assert time.perf_counter() - start < 5
