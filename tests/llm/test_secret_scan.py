from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from rows import ODD, documents, no_documents, odd_documents

from pulsegrid.llm import secret_scan
from pulsegrid.llm.secret_scan import RULES, Rule

#: The base kinds as they are defined, with their least lengths.
PLAIN = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)


def plain_spans(text: str | None) -> list[tuple]:
    rules = PLAIN + tuple(r for r in RULES[3:])
    return sorted(
        (m.start(), i, m.end())
        for i, (_, pattern, group, least) in enumerate(rules)
        for m in re.finditer(pattern, text or "", re.ASCII)
        if len(m.group(group)) >= least
    )


def report(text: str | None) -> tuple:
    spans = plain_spans(text)
    line = lambda some: ",".join(f"{RULES[i].kind}:{a}:{b}" for a, i, b in some)
    base = line(s for s in spans if s[1] < 3)
    return (*(sum(i == k for _, i, _ in spans) for k in range(3)), hashlib.sha256(base.encode()).hexdigest(), line(spans))


def some_texts() -> list[str]:
    chance = random.Random(8)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "API_KEY", " ", "  ", ":", "=", '"', "'", "é", "\n", "word",
             "abcdefgh", "abc", "0123456789abcdef" * 2, "AKIA", "AKIAABCDEFGH1234", "Z" * 12, "f" * 31, "a" * 40, "==", "/+_.-",
             "ghp_" + "a1" * 18, "xoxb-12345678901", "AIza" + "x" * 35, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 12 + "." + "b" * 12 + "." + "c" * 12, "\U0001f600"]
    return ["".join(chance.choices(parts, k=chance.randint(0, 25))) for _ in range(400)]


def test_spans(spark):
    texts = some_texts() + ["token=token:longsecretvalue1", "token==abcdefgh", "token = " + "ab " * 700, "password=abcdefgh1 é" * 700]
    rows = secret_scan.report(documents(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {i: report(t) for i, t in enumerate(texts)}


def test_every_match_satisfies_its_query():
    rules = [(r.pattern, secret_scan.trigram_query(r.pattern)) for r in RULES]
    hits = 0
    for text in some_texts():
        for pattern, query in rules:
            if re.search(pattern, text):
                hits += 1
                assert any(all(t in text.lower() for t in c) for c in query)
    assert hits > 300


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("abcd", [["abc", "bcd"]]),
        ("ab[cd]x", [["abc", "bcx"], ["abd", "bdx"]]),
        ("abc|xyz", [["abc"], ["xyz"]]),
        ("abc|x+", [[]]),
        ("(?:abc)?", [[]]),
        ("(?:abcd)+z", [["abc", "bcd"]]),
        ("ABC.*def", [["abc", "def"]]),
        ("a{3}", [["aaa"]]),
        ("[a-z]+", [[]]),
        ("abc|abcd", [["abc"]]),
    ],
)
def test_queries(pattern, want):
    assert sorted(map(sorted, secret_scan.trigram_query(pattern))) == want


def test_rules_of_ones_own(spark):
    rules = (Rule("code", r"code-(\d+)", 1, 3), Rule("any", r"[xyz]{4,}"))
    docs = documents(spark, ["code-12 code-123 xyzzy", "CODE-999", "xy zz"])
    rows = secret_scan.report(docs, rules, base=1).collect()
    assert {r.doc_id: (r.n_code, r.spans) for r in rows} == {0: (1, "code:8:16,any:17:22"), 1: (0, ""), 2: (0, "")}


def test_redaction(spark):
    texts = some_texts()[:120]
    docs = documents(spark, texts)
    found = secret_scan.redacted(docs)
    assert found.columns == docs.columns

    def plain(text):
        merged: list[list[int]] = []
        for start, _, end in plain_spans(text):
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        for start, end in reversed(merged):
            text = text[:start] + "[secret]" + text[end:]
        return text

    assert {r.doc_id: r.text for r in found.collect()} == {i: plain(t) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    rows = secret_scan.report(odd_documents(spark)).collect()
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in rows), key=key) == sorted(((r[0], *report(r[1])) for r in ODD), key=key)
    clean = secret_scan.redacted(odd_documents(spark))
    assert clean.columns == odd_documents(spark).columns and clean.count() == len(ODD)
    assert secret_scan.report(no_documents(spark)).count() == 0
    assert secret_scan.redacted(no_documents(spark)).count() == 0


def plain_redaction(text: str, mark: str = "[secret]") -> str:
    out, at, upto = [], 0, -1
    for start, _, end in plain_spans(text):
        if start >= upto:
            out += [text[at:start], mark]
        upto = max(upto, end)
        at = upto
    return "".join(out) + text[at:]


def test_redaction_of_many_spans_and_parts(spark, monkeypatch):
    texts = [*some_texts()[:150], "é" * 3000 + "token=abcdefgh1 " + "x" * 5000, "token=abcdefgh1", "token=abcdefgh1\U0001f600" * 300]
    for part in (7, 1024):
        monkeypatch.setattr(secret_scan, "PART", part)
        rows = secret_scan.redacted(documents(spark, texts)).collect()
        assert {r.doc_id: r.text for r in rows} == {i: plain_redaction(t) for i, t in enumerate(texts)}


def test_time_grows_with_the_text(spark):
    """20,000 spans in one text: in proportion, seconds."""
    def taken(n: int) -> float:
        text = "some words here, token=abcdefgh1 " * n
        start = time.perf_counter()
        found = secret_scan.redacted(documents(spark, [text])).select("text").first()[0]
        assert found == "some words here, [secret] " * n
        return time.perf_counter() - start

    taken(100)
    assert taken(20_000) < 8 * max(1.0, taken(5_000))
