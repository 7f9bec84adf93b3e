"""Removal of repeats against a plain search, the transform against sorted suffixes."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from rows import SCHEMA, no_documents, odd_documents

from pulsegrid.llm import repeats, transform

WIDTH = 50


def plain(rows) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, digest of the rest) of every row."""
    last = float("inf")
    first: dict[bytes, float] = {}
    known = [(r["doc_id"], (r["text"] or "").encode()) for r in rows]
    for i, text in known:
        for at in range(len(text) - WIDTH + 1):
            window = text[at:at + WIDTH]
            first[window] = min(first.get(window, last), last if i is None else i)
    out = []
    for i, text in known:
        gone = bytearray(len(text))
        for at in range(len(text) - WIDTH + 1):
            if first[text[at:at + WIDTH]] < (last if i is None else i):
                gone[at:at + WIDTH] = b"\x01" * WIDTH
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for a, b in zip(b"\x00" + gone, gone) if b and not a)
        out.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    found = [tuple(r) for r in repeats.removal_report(repeats.without_repeats(docs)).collect()]
    want = plain(docs.collect())
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return want


def corpus(seed: int, n: int) -> list[tuple]:
    chance = random.Random(seed)
    words = ["".join(chance.choices("abcdeé日", k=chance.randint(1, 6))) for _ in range(60)]
    prose = lambda k: " ".join(chance.choices(words, k=k))
    passages = [prose(chance.randint(8, 60)) for _ in range(8)] + ["x" * 70, "ab" * 40, "line of less than fifty bytes\n", "q" * 49, "z" * 50]
    rows = []
    for i in range(n):
        parts = [chance.choice(passages) if chance.random() < 0.4 else prose(chance.randint(0, 30)) for _ in range(chance.randint(0, 6))]
        doc_id = None if chance.random() < 0.1 else chance.randint(0, n)
        rows.append((doc_id, chance.choice(["", " ", "\n"]).join(parts), "en", "src", i))
    return rows + rows[:n // 10]


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_documents(spark, extra):
    check(spark, odd_documents(spark, extra))


def test_no_documents(spark):
    assert check(spark, no_documents(spark)) == []


def test_nothing_long_enough(spark):
    assert all(r[2] == 0 for r in check(spark, [(i, "z" * 49, "en", "s", 49) for i in range(5)]))


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    want = check(spark, corpus(seed, 150))
    assert sum(r[2] for r in want) > 1000


def test_many_packs_buckets_and_blocks(spark, monkeypatch):
    for name, value in {"PACK_BYTES": 3000, "BLOCK": 256, "GRAM_BYTES": 4000, "PIECE_BYTES": 9000}.items():
        monkeypatch.setattr(repeats, name, value)
    check(spark, corpus(3, 200))


def test_hot_grams_by_windows(spark, monkeypatch):
    """A line shorter than a window, behind and before ever other text: dealt by windows, the same result."""
    monkeypatch.setattr(repeats, "HOT", 5)
    monkeypatch.setattr(repeats, "PACK_BYTES", 2000)
    monkeypatch.setattr(repeats, "PIECE_BYTES", 4000)
    chance = random.Random(4)
    line = "a line of forty bytes that all of them have"
    noise = lambda: "".join(chance.choices("abcdefgh ", k=chance.randint(0, 60)))
    rows = [(i, f"{noise()}{line}{chance.choice(['one', 'two'])}{line}{noise()}", "en", "s", 0) for i in range(120)]
    assert sum(r[2] for r in check(spark, rows)) > 1000


def test_a_byte_of_a_letter_may_go(spark):
    """Strings are bytes: two letters that share their first byte are cut inside."""
    rows = [(1, "m" * 49 + "é", "en", "s", 0), (2, "m" * 49 + "è", "en", "s", 0)]
    assert [r[2] for r in check(spark, rows)] == [0, 50]
    kept = repeats.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in kept}[2] == "è".encode()[1:]


def test_only_pieces_with_partners_are_transformed(monkeypatch):
    """Copies are one piece, and without an unlike piece of their gram they stay out of the transform."""
    chance = random.Random(5)
    texts = [bytes(chance.choices(range(97, 123), k=400)) for _ in range(20)]
    near = texts[0][:200] + b"_" + texts[0][200:]
    body, sizes = b"".join([*texts, *texts, near]), np.array([400] * 40 + [401])
    ids = np.arange(41, 0, -1)
    pieces = repeats.Pieces(np.frombuffer(body, np.uint8), sizes)
    asked = repeats.Requests(pieces, ids, np.ones(pieces.start.size, np.uint8), 1)
    (_, numbers), = asked.by_bucket()
    parts = [asked.texts[i] for i in numbers]
    row = (7, 0, *(repeats.squeezed(a) for a in (np.frombuffer(b"".join(parts), np.uint8), np.array([len(t) for t in parts], np.uint8), asked.least[numbers])))
    given = []

    def counted(data, sizes, ids, width):
        given.append(sizes.size)
        return transform.least_ids(data, sizes, ids, width)

    monkeypatch.setattr(repeats, "least_ids", counted)
    out = repeats._matched(repeats.pa.Table.from_batches([repeats.rows(repeats.PIECES, [row])])).to_pylist()[0]
    first: dict[bytes, int] = {}
    for text, i in zip([*texts, *texts, near], ids.tolist()):
        for at in range(len(text) - WIDTH + 1):
            window = text[at:at + WIDTH]
            first[window] = min(first.get(window, i), i)
    want = [first[t[at:at + WIDTH]] for t in parts for at in range(len(t) - WIDTH + 1)]
    assert repeats.unsqueezed(out["least"], np.int64).tolist() == want
    assert sum(given) < len(parts) / 4


def test_only_windows_met_again_are_transformed(monkeypatch):
    """Pieces of a common gram whose windows all differ stay out, of others only what lies between their shared windows goes in."""
    chance = random.Random(7)

    def noise(n: int) -> bytes:
        return bytes(chance.choices(range(97, 123), k=n))

    core, long = noise(WIDTH - 5), noise(WIDTH + 3)
    short = [noise(40) + core + noise(40) for _ in range(30)]
    body = b"".join([*short, *(noise(40) + long + noise(40) for _ in range(2))])
    sizes = np.array([len(t) for t in short] + [WIDTH + 83] * 2)
    ids = np.arange(sizes.size, 0, -1)
    pieces = repeats.Pieces(np.frombuffer(body, np.uint8), sizes)
    asked = repeats.Requests(pieces, ids, np.ones(pieces.start.size, np.uint8), 3)
    given = []

    def counted(data, sizes, ids, width):
        given.extend(sizes.tolist())
        return transform.least_ids(data, sizes, ids, width)

    monkeypatch.setattr(repeats, "least_ids", counted)
    answers = []
    for bucket, numbers in asked.by_bucket():
        parts = [asked.texts[i] for i in numbers]
        row = (7, bucket, *(repeats.squeezed(a) for a in (np.frombuffer(b"".join(parts), np.uint8), np.array([len(t) for t in parts], np.uint8), asked.least[numbers])), asked.places())
        answers += repeats._answered(repeats.pa.Table.from_batches([repeats.rows(repeats.ASKED, [row])])).to_pylist()
    assert sum(given) <= 2 * len(long) + 2 * WIDTH  # a border of pieces may lie inside
    gone = repeats._removed(ids, sizes, answers)
    assert np.flatnonzero(gone).tolist() == [*range(sizes[:-2].sum() + 40, sizes[:-2].sum() + 40 + len(long))]
    start, _, windows = repeats._placed(asked.places())
    assert start.tolist() == asked.start.tolist() and windows.tolist() == asked.windows.tolist()


@pytest.mark.parametrize("sizes", [[], [0, 0], [5, 0, 65_531, 1, 70_000, 3], [1] * 257])
def test_segments_read_together(sizes):
    """Every segment once, in order; several only where they are small."""
    spans = [*transform._together(np.array(sizes, np.int64))]
    assert [k for i, j in spans for k in range(i, j)] == [*range(len(sizes))]
    assert all(j - i <= 256 and (j - i <= 1 or sum(sizes[i:j]) <= transform.TOGETHER) for i, j in spans)


def test_large_transform(monkeypatch):
    """Segments alone and together give the same transform."""
    chance = random.Random(3)
    strings = [bytes(chance.choices(b"ab\x00cdefgh\xbf", k=chance.randint(0, 60))) for _ in range(400)]
    strings += strings[:100]
    data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    found = []
    for together in (transform.TOGETHER, 2_000, 1):
        monkeypatch.setattr(transform, "TOGETHER", together)
        made = transform.Collection(data, sizes)
        found.append([a.tolist() for a in made.arrays()])
        made.close()
    assert found[0] == found[1] == found[2]
    suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    assert [transform.END if i == 0 else strings[k][i - 1] for _, k, i in suffixes] == found[0][0]


def shared(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("letters", [b"a", b"ab", b"ab\x00c", bytes(range(0xC0))])
def test_transform(letters):
    chance = random.Random(len(letters))
    for _ in range(60):
        strings = [bytes(chance.choices(letters, k=chance.randint(0, 12))) for _ in range(chance.randint(1, 12))]
        data = np.frombuffer(b"".join(strings), np.uint8)
        made = transform.Collection(data, np.array([len(s) for s in strings]))
        symbols, prefixes = made.arrays()
        suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        assert prefixes.tolist() == [0] + [shared(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
        placed = {(k, len(strings[k]) - length): p for length, ks, ps in made.ranks(0) for k, p in zip(ks.tolist(), ps.tolist())}
        assert sorted(placed.values()) == [*range(len(suffixes))]
        by_place = sorted(placed, key=placed.get)
        assert [strings[k][i:] for k, i in by_place] == [s for s, _, _ in suffixes]
        assert [transform.END if i == 0 else strings[k][i - 1] for k, i in by_place] == symbols.tolist()
        made.close()
