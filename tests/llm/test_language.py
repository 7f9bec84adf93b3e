from __future__ import annotations

import random

import numpy as np
import pytest
from rows import ODD, SCHEMA, no_documents, odd_documents

from pulsegrid.llm import language

SYLLABLES = {
    "aa": "ka to mi re sol".split(),
    "bb": "schn pfl ung tz ö".split(),
    "cc": "да не при что".split(),
}


def text_in(tongue: str, words: int, chance: random.Random) -> str:
    return " ".join("".join(chance.choices(SYLLABLES[tongue], k=chance.randint(1, 4))) for _ in range(words))


def corpus(spark, n: int = 240):
    chance = random.Random(9)
    rows, truth = [], {}
    for i in range(n):
        tongue = "aabbcc"[2 * (i % 3):2 * (i % 3) + 2]
        declared = tongue if i % 10 else ("aa", "BB-xx", None)[i // 10 % 3]
        rows.append((i, text_in(tongue, 1 if i % 7 == 0 else 30, chance), declared, f"host{i % 3}", 0))
        truth[i] = tongue
    return spark.createDataFrame(rows, SCHEMA), truth


def test_texts_win_over_wrong_declarations(spark):
    docs, truth = corpus(spark)
    rows = language.document_languages(docs).collect()
    long = [r for r in rows if r.doc_id % 7]
    assert all(r.language == truth[r.doc_id] and r.kept for r in long)
    assert sum(r.language == truth[r.doc_id] for r in rows) >= 0.95 * len(rows)
    out = language.identified_documents(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: r.language for r in rows if r.kept}
    assert {r.doc_id: r.lang.lower()[:2] for r in out.collect()} == found


def test_likelihoods_are_sums_over_trigrams(spark):
    docs, _ = corpus(spark)
    model = language.fit(docs)
    texts = ["Kato, mire! 12", "x", None, "", "schnung  tz", "a\0b c"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = [r[0] for r in frame.select(language.likelihoods(frame.text, model)).collect()]
    tables = [*model.table, np.append(np.full(language.CELLS, -np.log(language.CELLS)), 0.0)]
    for text, row in zip(texts, rows, strict=True):
        low = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        grams = [low[i:i + 3] for i in range(len(low) - 2) if "  " not in low[i:i + 3]]
        want = np.zeros(len(tables))
        for gram in grams:
            cells = language._cells([gram])[0]
            # the gram by itself is framed by blanks: its own cell is the one in the middle
            want += language.WEIGHT * np.array([t[_cell(gram)] for t in tables])
            assert _cell(gram) in cells
        assert row == pytest.approx(list(want))


def _cell(gram: str) -> int:
    a, b, c = (np.array([ord(x)], np.uint32) for x in gram)
    return int((((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))) >> np.uint32(17))[0])


def test_evidence_is_fused(spark):
    docs, _ = corpus(spark)
    model = language.fit(docs)
    chance = random.Random(3)
    rows = [(f"{t}{i}", text_in(t, 30, chance), t, t, f"www.{t}.example") for i in range(40) for t in SYLLABLES]
    rows += [("same", "12 x", "aa", "aa", "www.aa.example"), ("bare", "x", None, None, None), ("none", "12 34", "bb", "bb", "www.bb.example")]
    frame = spark.createDataFrame(rows, "id string, text string, declared string, suffix string, host string")
    found = {r.id: r for r in language.identify(frame, model, ["host"], ["declared", "suffix"]).collect()}
    assert all(r.language == i[:2] for i, r in found.items() if i[2:].isdigit())
    # the letter x says little: declaration, suffix and host decide
    assert found["same"].language == "aa" and found["same"].kept and found["same"].posterior > found["bare"].posterior
    # without a letter there is nothing to keep, whatever is declared
    assert found["none"].language == "bb" and not found["none"].kept


def test_every_declared_language_is_modelled(spark):
    chance = random.Random(7)
    tags = [a + b for a in "ghijklmno" for b in "abcdefgh"]
    alphabet = {t: [chr(0x4E00 + 3 * i), chr(0x4E01 + 3 * i), chr(0x4E02 + 3 * i)] for i, t in enumerate(tags)}
    words = lambda t: " ".join("".join(chance.choices(alphabet[t], k=4)) for _ in range(30))
    # the last one has two texts only; one text more of each is not declared
    rows = [(t, words(t), t) for i, t in enumerate(tags) for _ in range(2 if i == len(tags) - 1 else 5)]
    rows += [(t, words(t), None) for t in tags]
    docs = spark.createDataFrame([(i, x, d, "src0", 0) for i, (_, x, d) in enumerate(rows)], SCHEMA)
    model = language.fit(docs)
    assert model.languages == sorted(tags) and model.table.dtype == np.float32
    found = language.document_languages(docs).collect()
    assert all(r.language == rows[r.doc_id][0] and r.kept for r in found)


def test_a_declared_language_without_a_model_is_kept(spark):
    docs, _ = corpus(spark)
    model = language.fit(docs)
    rows = [("x", text_in("aa", 30, random.Random(1)), "zz"), ("y", "12 34", "zz"), ("z", text_in("aa", 30, random.Random(2)), None)]
    frame = spark.createDataFrame([(*r, "h") for r in rows], "id string, text string, declared string, host string")
    found = {r.id: r for r in language.identify(frame, model, ["host"], ["declared"]).collect()}
    assert (found["x"].language, found["x"].kept, found["x"].posterior) == ("zz", True, None)
    assert not found["y"].kept and (found["z"].language, found["z"].kept) == ("aa", True)


def test_pages(spark):
    docs, _ = corpus(spark)
    model = language.fit(docs)
    chance = random.Random(2)
    body = lambda t: f"<html lang='{t}-XX'><script>var да=1</script><p>{text_in(t, 40, chance)}</p>&nbsp;<!-- не --></html>"
    rows = [(i, f"https://h{i % 4}.example.{t}/{t}/{i}", body(t)) for i in range(20) for t in SYLLABLES]
    rows += [(100, None, None), (101, "no address", "<p></p>"), (None, "http://x.y/aa", body("aa"))]
    found = language.page_languages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert len(found) == len(rows)
    assert sorted(r.language for r in found if r.page_id is not None and r.page_id < 100) == sorted([*SYLLABLES] * 20)
    assert [r.kept for r in found if r.page_id in (100, 101)] == [False, False]


def test_odd_rows(spark):
    docs, _ = corpus(spark)
    mixed = odd_documents(spark).unionByName(odd_documents(spark, extra=False), allowMissingColumns=True)
    rows = language.document_languages(mixed).collect()
    assert len(rows) == 2 * len(ODD)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3))
    kept = language.identified_documents(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and kept.count() <= len(ODD)
    assert language.document_languages(no_documents(spark)).count() == 0
    assert language.identified_documents(no_documents(spark)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    assert not any(r.kept for r in language.document_languages(unlabelled).collect())
