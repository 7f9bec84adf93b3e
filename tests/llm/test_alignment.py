"""Alignments against the two libraries and plain loops."""

from __future__ import annotations

import hashlib
import json
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from rows import documents, no_documents, odd_documents
from tokenizers import Tokenizer

from pulsegrid.llm import alignment
from pulsegrid.llm.perfect_hash import PerfectHash

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def letters():
    return alignment._byte_letters()


def tokens(libraries, letters, text: str | None):
    """Ids and bytes of both, or nothing."""
    first, second = libraries
    if not text:
        return [], []
    a = first.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(letters[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def groups(a, b):
    """[(ids of a, ids of b)] between common ends."""
    out, mine, other, at, i = [], [], [], 0, 0
    end = 0
    for token, data in a:
        mine.append(token)
        at += len(data)
        while i < len(b) and end + len(b[i][1]) <= at:
            other.append(b[i][0])
            end += len(b[i][1])
            i += 1
        if end == at:
            out.append((mine, other))
            mine, other = [], []
    return out


def plain(libraries, letters, rows) -> list[tuple]:
    found = [(r["doc_id"], *tokens(libraries, letters, r["text"])) for r in rows]
    cut = [groups(a, b) for _, a, b in found]
    counts = Counter()
    for g in cut:
        counts.update({(x, y) for mine, other in g for x in mine for y in other})
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc_id, a, b), g in zip(found, cut):
        links = [(x, y) for mine, other in g for x in mine for y in other]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append(
            (doc_id, len(a), len(b), len(g), len(links), sum(counts[k] == most[k[0]] for k in links),
             sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest() if a else "")
        )
    return out


def found(docs) -> list[tuple]:
    made = alignment.digests(alignment.aligned_documents(docs, A, public_tokenizers.PATTERN, B))
    return [tuple(r) for r in made.collect()]


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_documents(spark, libraries, letters, extra):
    docs = odd_documents(spark, extra)
    assert sorted(found(docs), key=repr) == sorted(plain(libraries, letters, docs.collect()), key=repr)


def test_no_documents(spark):
    assert found(no_documents(spark)) == []


def test_many_packs_large_groups_and_small_portions(spark, libraries, letters, monkeypatch):
    monkeypatch.setattr(alignment, "PACK_BYTES", 400)
    monkeypatch.setattr(alignment, "TREE", 3)
    monkeypatch.setattr(alignment, "LINKS", 8)
    chance = random.Random(3)
    pool = [*"abcdeinrst THE\n\t  éèñß0123.,!'", *"日本語的한국어русскийلا", "́", "\U0001f600", "\x00", "▁", "<s>", "<|endoftext|>", " the", " and"]
    texts = ["".join(chance.choices(pool, k=chance.randint(0, 120))) for _ in range(300)]
    docs = documents(spark, texts + texts[:40])
    assert sorted(found(docs), key=repr) == sorted(plain(libraries, letters, docs.collect()), key=repr)


def _pack(n: int, tokens: int):
    """Ids of `n` documents, a third without tokens, on vocabularies of words of 1 to 3 bytes; both sides have the same bytes."""
    chance = np.random.default_rng(5)
    size_a, size_b = np.array([1, 2, 3] * 300), np.array([1, 1, 2] * 200)
    a, b, n_a, n_b = [], [], [], []
    for i in range(n):
        x = chance.integers(0, size_a.size, tokens if i % 3 else 0)
        y = chance.integers(0, size_b.size, 2 * x.size)
        y = y[: np.searchsorted(np.cumsum(size_b[y]), size_a[x].sum())]
        y = np.concatenate([y, np.zeros(size_a[x].sum() - size_b[y].sum(), np.int64)])
        a.append(x), b.append(y), n_a.append(x.size), n_b.append(y.size)
    return np.concatenate(a).astype(np.uint16), np.concatenate(b).astype(np.uint16), np.array(n_a), np.array(n_b), size_a, size_b


def _aligned(parts, keys, counts, best, written):
    made = []
    for part in parts:
        numbers = (c.tolist() for c in (part.n_a, part.n_b, part.n_groups, *part.sums(keys, counts, best)))
        made += zip(*numbers, part.texts(written), strict=True)
    return made


@pytest.mark.parametrize("portion", [1, 50, 1000])
def test_portions_of_a_pack_are_the_pack(monkeypatch, portion):
    pack = _pack(40, 60)
    width = pack[-1].size
    keys, docs = alignment.pack_pairs(iter([alignment.Aligned(*pack)]), width)
    monkeypatch.setattr(alignment, "PORTION", portion)
    parts = [*alignment.portions(*pack)]
    assert len(parts) > 4 and all(p.n_a.size == 1 or p.a.size + p.b.size <= portion for p in parts)
    mine = alignment.pack_pairs(iter(parts), width)
    assert np.array_equal(mine[0], keys) and np.array_equal(mine[1], docs)
    assert np.array_equal(keys, sorted(keys.tolist(), key=lambda k: (k // width % alignment.BUCKETS, k)))
    order = np.argsort(keys)
    known = keys[order], docs[order], docs[order] > 3, alignment._written(pack[-2].size, width)
    assert _aligned(parts, *known) == _aligned([alignment.Aligned(*pack)], *known)


def test_memory_of_a_pack_is_that_of_a_portion():
    """1,500,000 tokens took 113 MB in one piece; on check_h an executor ran out of its 3,000 MB."""
    pack = _pack(600, 1500)
    width = pack[-1].size
    written = alignment._written(pack[-2].size, width)
    keys, docs = alignment.pack_pairs(alignment.portions(*pack), width)
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    assert pack[0].size + pack[1].size > 8 * alignment.PORTION
    tracemalloc.start()
    try:
        for part in alignment.portions(*pack):
            part.sums(keys, docs, docs > 3)
            assert sum(map(len, part.texts(written)))
        alignment.pack_pairs(alignment.portions(*pack), width)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 60 << 20


def test_no_stage_has_two_python_processes(spark, monkeypatch):
    """An executor's idle processes keep what they took, so a second one in a task counts to the end."""
    plans = {}
    write = alignment.materialise

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(alignment, "materialise", kept)
    found(documents(spark, ["a b c", "", None, "one two two"]))
    assert plans.keys() == {"tokens", "pairs", "hashes", "counts"}
    assert "FlatMapGroupsInArrow" in plans["hashes"]
    assert "MapInArrow" not in plans["hashes"].replace("FlatMapGroupsInArrow", "")


def test_ids_of_the_file(libraries):
    """tiktoken with the file's vocabulary, the library for runs of blanks beyond its stack: the same ids."""
    with open(A, encoding="utf-8") as file:
        text = file.read()
    vocabulary = alignment.byte_vocabulary(text)
    encode = alignment.ByteTokens(text, vocabulary, public_tokenizers.PATTERN)
    first, _ = libraries
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x10D40, 0x10D70)) + [0x1C89, 0xA7CB, 0x1ACE]
    samples = [f" a{chr(c)}b1{chr(c)}2 {chr(c)}!{chr(c)} {chr(c)}\n{chr(c)}" for c in points]
    samples += [" " * 30_000 + "x", "\n \t" * 400_000, "x" * 100_000, " it's we'll I'M"]
    for sample in samples:
        assert encode(sample) == first.encode(sample, add_special_tokens=False).ids


def test_merges_out_of_order_are_refused():
    vocabulary = {chr(i + 1000): i for i in range(256)} | {"ab": 257, "cd": 256}
    with pytest.raises(ValueError):
        alignment.byte_vocabulary(json.dumps({"model": {"vocab": vocabulary, "merges": [["a", "b"], ["c", "d"]]}}))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32))
    function = PerfectHash.build(keys)
    again = PerfectHash.load(function.dump())
    assert sorted(function(keys).tolist()) == [*range(keys.size)]
    assert np.array_equal(again(keys), function(keys))
    other = np.setdiff1d(np.arange(1000, dtype=np.uint32), keys)
    assert function(other).max(initial=-1) < keys.size
    if n >= 1000:
        assert 8 * len(function.dump()) < 8 * keys.size
