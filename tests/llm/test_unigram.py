from __future__ import annotations

import random
import time

import public_tokenizers
import pytest
from rows import ODD, no_documents, odd_documents
from tokenizers import Tokenizer, models

from pulsegrid.llm import unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(vocabulary):
    low = min(s for _, s in vocabulary)
    whole = [("<unk>", low), *vocabulary, *((f"<0x{b:02X}>", low) for b in range(256))]
    return Tokenizer(models.Unigram(whole, unk_id=0, byte_fallback=True))


def wanted(tokenizer, text: str | None) -> int:
    text = unigram.SPACE + text.replace(" ", unigram.SPACE) if text else ""
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return unigram.vocabulary(file.read())


def texts() -> list[str]:
    chance = random.Random(2)
    pool = [*"abcdeinrst THE▁\n\t  éèñß0123.,!", *"日本語的한국어русскийلا", "́", "\U0001f600", "\x00", "​"]
    out = ["".join(chance.choices(pool, k=chance.randint(0, 80))) for _ in range(2500)]
    out += ["   ", " a  b ", "\n\n\n", "a" * 2000, "▁▁ ▁", "<0x0A> <unk> </s>", "x y " * 300 + "z" * 70 + " " + "z" * 70, "\n a\n"]
    return out


def test_counts_are_the_librarys(vocabulary):
    counter, reference = unigram.Counter(vocabulary), library(vocabulary)
    for text in texts():
        assert counter.count(text)[0] == wanted(reference, text)


def test_ties_and_pieces_across_words():
    pieces = [("▁a", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁", -1.0), ("b▁a", -2.5), ("\nb", -1.0), ("\n", -3.0)]
    counter, reference = unigram.Counter(pieces), library(pieces)
    chance = random.Random(1)
    assert not counter.words
    for _ in range(1500):
        text = "".join(chance.choices("aab b\nc", k=chance.randint(0, 14)))
        assert counter.count(text)[0] == wanted(reference, text)
    plain = [p for p in pieces if p[0] != "b▁a"]
    counter, reference = unigram.Counter(plain), library(plain)
    assert counter.words
    for _ in range(1500):
        text = "".join(chance.choices("aab b\nc", k=chance.randint(0, 14)))
        assert counter.count(text)[0] == wanted(reference, text)


def test_scores_add_up(vocabulary):
    counter = unigram.Counter(vocabulary)
    scores = dict(vocabulary)
    known = counter.count("the")
    assert known == (2, scores["▁t"] + scores["he"])
    # a character without a piece: its bytes, and ten less than the worst piece
    parts = [("▁t", "h", "e"), ("▁t", "he")]
    assert known[1] == max(sum(map(scores.get, p)) for p in parts)
    rare = next(c for c in map(chr, range(0x1F000, 0x1FFFF)) if c not in counter.letters)
    assert counter.count("the" + rare) == (known[0] + 4, known[1] + min(scores.values()) - 10)


def test_results_do_not_depend_on_what_is_kept(vocabulary, monkeypatch):
    some = texts()[::5]
    whole = [unigram.Counter(vocabulary).count(t) for t in some]
    monkeypatch.setattr(unigram, "KEPT", 10)
    monkeypatch.setattr(unigram, "KEPT_LETTERS", 3)
    counter = unigram.Counter(vocabulary)
    assert [counter.count(t) for t in some] == whole


def test_odd_rows(spark, vocabulary):
    reference = library(vocabulary)
    rows = unigram.token_counts(odd_documents(spark), PATH).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=key) == sorted(((r[0], wanted(reference, r[1])) for r in ODD), key=key)
    assert unigram.token_counts(no_documents(spark), PATH).count() == 0


def test_many_long_words(vocabulary):
    words = [f"{i:0>6}" * 12 for i in range(4_000)]
    counter = unigram.Counter(vocabulary)
    start = time.perf_counter()
    found = counter.count(" ".join(words + words))
    assert time.perf_counter() - start < 20
    alone = [counter.count(w) for w in words]
    assert found[0] == 2 * sum(n for n, _ in alone)
    assert found[1] == pytest.approx(2 * sum(s for _, s in alone))
