"""Manifests against a plain recursive one."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from rows import SCHEMA, no_documents, odd_documents

from pulsegrid.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    values = [row[c] for c in merkle.LEAF_COLUMNS]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes: list[str], fanout: int = 16):
    """Root and each leaf's path."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for path, i in zip(paths, at):
            first = i - i % fanout
            path.append(("".join(hashes[first:i]), "".join(hashes[i + 1:first + fanout])))
        hashes = [sha("".join(hashes[i:i + fanout])) for i in range(0, len(hashes), fanout)]
        at = [i // fanout for i in at]
    return (hashes or [""])[0], paths


def fold(node: str, path) -> str:
    for before, after in path:
        node = sha(before + node + after)
    return node


def plain(rows) -> list[tuple]:
    """What verified_documents returns, from a list of documents."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {}
    for s in sources:
        own = [(leaf(r), r) for r in rows if r["source"] == s]
        own.sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        of[s] = own, *tree([h for h, _ in own])
    root, above = tree([of[s][1] for s in sources])
    out = []
    for s, up in zip(sources, above):
        own, subroot, paths = of[s]
        for (h, r), path in zip(own, paths):
            whole = path + up
            other = h
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                other = leaf({**r.asDict(), "text": lower})
            end = fold(other, whole)
            out.append((r["doc_id"], h, subroot, root, sha("".join(b + a for b, a in whole)), end, end == root))
    return out


def key(row: tuple) -> str:
    return repr(row)


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_documents(spark, extra):
    docs = odd_documents(spark, extra)
    rows = [tuple(r) for r in merkle.verified_documents(docs).collect()]
    assert sorted(rows, key=key) == sorted(plain(docs.collect()), key=key)


def test_no_documents(spark):
    assert merkle.verified_documents(no_documents(spark)).count() == 0


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_every_size_of_a_group(spark, fanout):
    sizes = [1, 2, 3, 4, 5, 8, 9, 15, 16, 17, 27, 28, 31, 33, 100, 255, 256, 257, 300]
    rows = [(f"g{n}", i, sha(f"{n}/{i}")) for n in sizes for i in range(n)]
    random.Random(fanout).shuffle(rows)
    made = merkle.manifest(spark.createDataFrame(rows, "group string, id long, leaf string"), ["id"], fanout)
    found = made.withColumn("end", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(found) == len(rows)
    for n in sizes:
        root, paths = tree([sha(f"{n}/{i}") for i in range(n)], fanout)
        for r in (r for r in found if r["group"] == f"g{n}"):
            assert (r["root"], r["end"]) == (root, root)
            assert [tuple(s) for s in r["path"]] == paths[r["id"]]


def test_a_large_group_is_numbered_in_slices(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SLICE_ROWS", 200)
    rows = [(i // 3 if i % 7 else None, f"Text {i % 50}", "en", "hot" if i % 3 else None, i) for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in merkle.verified_documents(docs).collect()]
    want = plain(docs.collect())
    assert sorted(found, key=key) == sorted(want, key=key)
    assert 0 < sum(not r[-1] for r in want) < 600


def test_a_changed_row_changes_its_own_source_only(spark):
    rows = [(i, f"text {i}", "en", f"src{i % 4}", i) for i in range(200)]
    other = [(i, "changed" if i == 6 else t, *rest) for i, t, *rest in rows]
    one, two = (
        {(r["doc_id"], r["source"]): r for r in merkle.dataset_manifest(spark.createDataFrame(d, SCHEMA)).collect()}
        for d in (rows, other)
    )
    assert {k[1] for k in one if one[k]["subroot"] != two[k]["subroot"]} == {"src2"}
    assert all(one[k]["root"] != two[k]["root"] for k in one)
    assert [k[0] for k in one if one[k]["leaf"] != two[k]["leaf"]] == [6]
