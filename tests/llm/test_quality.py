from __future__ import annotations

import random
import re
from collections import Counter

from rows import ODD, documents, no_documents, odd_documents

from pulsegrid.llm import quality
from pulsegrid.llm.quality import Threshold


def plain(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    n, repeated = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n


def test_counts(spark):
    chance = random.Random(2)
    words = ["a", "b", "the", "of", "#x", "日本", "é<", "\t", "\n"]
    texts = [" ".join(chance.choices(words[:chance.randint(2, 9)], k=chance.randint(0, 120))) for _ in range(150)]
    rows = quality.quality(documents(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:7] for r in rows} == {i: plain(t) for i, t in enumerate(texts)}
    assert all(not (r.kept and r.base_failed) and r.kept == (not r.base_failed and not r.broken) for r in rows)


def test_odd_rows(spark):
    rows = quality.quality(odd_documents(spark)).collect()
    found = sorted((str(r[0]), *tuple(r)[1:7]) for r in rows)
    assert found == sorted((str(r[0]), *plain(r[1])) for r in ODD)
    assert quality.quality(no_documents(spark)).count() == 0


def test_thresholds_are_compiled(spark):
    prose = " ".join(f"the word{i} of" for i in range(40))
    texts = [prose, prose.replace("word", "*%*"), " ".join(f"plain{i}" for i in range(80)), "\n".join(["the of and it"] * 3 + [prose])]
    rules = (Threshold("symbols", "symbol_ratio", most=0.1), Threshold("stops", "n_stop_words", least=2))
    rows = sorted(quality.quality(documents(spark, texts), rules).collect())
    assert [r.broken for r in rows] == [[], ["symbols"], ["stops"], []]
    both = (Threshold("words", "n_words", least=100, most=130),)
    assert [r.kept for r in sorted(quality.quality(documents(spark, texts), both).collect())] == [True, True, False, False]
