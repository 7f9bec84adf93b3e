from __future__ import annotations

import hashlib
import random

import numpy as np
from rows import ODD, documents, no_documents, odd_documents

from pulsegrid.llm import phrases


def some_text(seed: int, words: int) -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefghéü", k=chance.randint(2, 9))) for _ in range(words))


def names(text: str) -> list[set]:
    return [set(found.tolist()) for _, found, _, _ in phrases.phrases([text.encode()])]


def test_equal_substrings_share_their_names_at_any_offset():
    shared = some_text(1, 400)
    for before in ("", "x", "xy ", some_text(2, 37)):
        a, b = names(some_text(3, 50) + shared), names(before + shared + some_text(4, 11))
        for level in (1, 2, 3):
            own = names(shared)[level]
            assert len(own & a[level] & b[level]) >= len(own) - 8


def test_blocks_are_short_and_labels_differ():
    chance = np.random.default_rng(1)
    data = np.cumsum(chance.integers(1, 250, 100_000)).astype(np.uint8)
    for symbols in (data, data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)):
        labels = phrases._labels(symbols, np.array([0]))
        assert labels.max() < 6 and (labels[1:] != labels[:-1]).all()
        sizes = np.diff(phrases._blocks(labels, np.array([0])))
        assert sizes.max() <= 12 and sizes[1:].min() >= 2


def test_a_fingerprint_is_the_texts_own():
    texts = [some_text(i, i * 7) for i in range(1, 40)] + ["", "a", "aaaa", "é", "ab" * 500, "\x00" * 50]
    together = phrases.fingerprints(texts)
    assert together == [phrases.fingerprints([t])[0] for t in texts]
    assert len(set(together)) == len(set(texts))
    assert phrases.similarity(together[0], together[0]) == 1.0
    assert phrases.similarity("", together[0]) == 0.0


def test_likeness_estimates_the_shared_part():
    base = some_text(1, 3000)
    other = some_text(2, 3000)
    for share in (0.25, 0.5, 0.75):
        cut = int(len(base) * share)
        a, b = phrases.fingerprints([base, base[:cut] + other[cut:]])
        assert abs(phrases.similarity(a, b) - share) < 0.2
    a, b = phrases.fingerprints([base, other])
    assert phrases.similarity(a, b) < 0.1


def test_repeats_weigh_as_much_as_other_text():
    texts = ["a" * 5000, "b" * 5000, "ab" * 5000, " " * 5000, "buy now " * 1000, "a longer line that is said again\n" * 300, "a" * 100, "b" * 100]
    prints = phrases.fingerprints(texts)
    assert prints == [phrases.fingerprints([t])[0] for t in texts]
    for i, text in enumerate(texts):
        assert all(phrases.similarity(prints[i], p) < 0.1 for p in prints[i + 1:] if len(text) > 2048)
        cut = len(text) // 3
        for other in (texts[(i + 1) % len(texts)] * 60, some_text(5, 3000)):
            edit = phrases.fingerprints([text[:len(text) - cut] + other[:cut]])[0]
            near = phrases.similarity(prints[i], edit)
            assert abs(near - 2 / 3) < 0.25, (text[:8], near)
    assert len(set(prints)) == len(texts)


def plain_edits(rows: list[tuple]) -> list[tuple]:
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for n, (doc, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 3
        out.append((doc, len(text), text[:len(text) - cut] + after[:cut], after, text))
    return out


def check(spark, docs, rows):
    want = [
        (d, n, hashlib.sha256(e.encode()).hexdigest(), *phrases.fingerprints([t, e]), *(
            phrases.similarity(*phrases.fingerprints([t, x])) for x in (e, after)))
        for d, n, e, after, t in plain_edits(rows)
    ]
    key = lambda r: str(tuple(r))
    found = phrases.edited_fingerprints(docs).collect()
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_edits_follow_descending_ids(spark):
    texts = [some_text(i, 1 + i * 13 % 90) for i in range(300)]
    check(spark, documents(spark, texts).repartition(7), list(enumerate(texts)))
    check(spark, documents(spark, ["only one text"]), [(0, "only one text")])


def test_odd_rows(spark):
    check(spark, odd_documents(spark), [r[:2] for r in ODD])
    assert phrases.edited_fingerprints(no_documents(spark)).count() == 0
    texts = phrases.edited_fingerprints(documents(spark, ["abcdef", "xyz"]), keep_text=True).collect()
    assert {r.doc_id: r.edited for r in texts} == {0: "abcdxy", 1: "xya"}


def test_columns(spark):
    docs = documents(spark, ["a text of some words", None])
    found = docs.select(phrases.fingerprint(docs.text).alias("f"))
    first, none = (r.f for r in found.collect())
    assert none == "" and first == phrases.fingerprints(["a text of some words"])[0]
    assert [r[0] for r in found.select(phrases.likeness(found.f, found.f)).collect()] == [1.0, 1.0]
