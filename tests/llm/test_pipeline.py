"""Every stage on its own input, and the whole."""

from __future__ import annotations

import re

import pytest
import test_simhash
from rows import no_documents, odd_documents
from test_secret_scan import plain_spans

import corpus_pipeline
from pulsegrid.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], sf), name))
    return out


def test_languages_keep_clean_documents(stages):
    docs, kept = stages[0].collect(), stages[1].collect()
    assert stages[1].columns == COLUMNS
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in docs if re.search(r"[^\W\d_]", r.text))


def test_one_document_of_a_group_stays(stages):
    docs = sorted(stages[1].collect())
    prints = {r.doc_id: test_simhash.plain_fingerprint(r.text) for r in docs}
    near = lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4
    want = test_simhash.plain_components([r.doc_id for r in docs], near)
    assert stages[2].columns == COLUMNS
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(want.values()))


def test_secrets_are_gone(stages):
    docs, clean = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert stages[3].columns == COLUMNS and docs.keys() == clean.keys()
    for doc, row in clean.items():
        assert not plain_spans(row.text) and row.n_chars == len(row.text)
        assert (row.text == docs[doc].text) == (not plain_spans(docs[doc].text))


def test_the_mixture_repeats_or_drops_whole_documents(stages):
    before, after = (s.collect() for s in stages[3:5])
    assert stages[4].columns == COLUMNS
    assert set(map(tuple, after)) <= set(map(tuple, before))


def test_all_that_is_left_is_encoded(stages):
    assert sorted(r.doc_id for r in stages[5].collect()) == sorted(r.doc_id for r in stages[4].collect())
    assert all(r.n_tokens == len(r.ids) for r in stages[5].collect())


def test_run_is_its_stages(spark, sf, stages):
    found = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, found.collect())) == sorted(map(str, stages[5].collect()))


@pytest.mark.parametrize("docs", [odd_documents, no_documents])
def test_odd_rows(spark, sf, docs):
    rows = docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        rows = materialise(stage(spark, rows, sf), name)
    rows.collect()
