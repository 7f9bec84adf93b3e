"""Quality rules as one projection of native expressions.

Measures of a text are ratios of its words, lines and symbols. A threshold table (rule,
measure, least, most) is compiled into one condition over them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[^#*$%&|<>]+"

#: Common words of the corpus' languages.
STOP_WORDS = tuple(
    "the of and to in is that it for was with as on by this from or are at an be "
    "der die und das den von zu mit sich des ein eine für auf ist im dem nicht "
    "de la le les et un une est que qui dans pour par sur du en el los las y del se por con para su al"
    .split()
)


class Threshold(NamedTuple):
    """A text passes if the measure lies between least and most; None sets no bound."""

    rule: str
    measure: str
    least: float | None = None
    most: float | None = None


THRESHOLDS = (
    Threshold("word_count", "n_words", least=50),
    Threshold("mean_word_length", "mean_word", least=2, most=12),
    Threshold("symbols_per_word", "symbol_ratio", most=0.1),
    Threshold("distinct_stop_words", "n_stop_words", least=2),
    Threshold("repeated_lines", "dup_line_ratio", most=0.4),
    Threshold("repeated_words", "repeat_ratio", most=0.5),
)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _gram(words: Column, at: Column) -> Column:
    return F.concat_ws(" ", F.get(words, at), F.get(words, at + 1), F.get(words, at + 2))


def _beside_equal(values: Column, key) -> Column:
    """Elements of a sorted array whose key equals a neighbour's."""
    return F.filter(
        values,
        lambda x, i: (key(x) == key(F.get(values, i - 1))) | (key(x) == key(F.get(values, i + 1))),
    )


def with_measures(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` (no column may be called _q) with a struct `_q` of a text's measures.

    A null or empty text has no words and every ratio is 0. Words are runs of anything but ASCII
    white space. n_repeat_words counts words in three-word windows that occur twice or more: windows are
    sorted by the upper half of a hash beside their place, and those whose halves meet are
    compared as they are, so the count is exact and a text is never compared with itself pairwise.
    """
    high = F.lit(32)
    part = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    part = part.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    part = part.withColumn("_lines", lines)
    words = F.col("_words")
    starts = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    packed = F.transform(
        starts,
        lambda i: F.shiftleft(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), 32).bitwiseOR(i.cast("bigint")),
    )
    part = part.withColumn("_keys", F.sort_array(packed))
    met = _beside_equal(F.col("_keys"), lambda x: F.shiftright(x, 32))
    places = F.transform(met, lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    windows = F.transform(places, lambda i: F.struct(_gram(words, i).alias("gram"), i.alias("at")))
    part = part.withColumn("_windows", F.sort_array(windows))
    repeats = F.transform(_beside_equal(F.col("_windows"), lambda x: x["gram"]), lambda x: x["at"])
    part = part.withColumn("_places", F.sort_array(repeats))
    places = F.col("_places")
    covered = F.transform(places, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - x, F.lit(3))))
    counts = part.withColumn(
        "_q",
        F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.char_length(F.regexp_replace("_text", SYMBOL, "")).cast("bigint").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            _sum(covered).alias("n_repeat_words"),
            F.size(F.array_intersect(F.split(F.lower(F.array_join(words, " ")), " "), F.lit([*STOP_WORDS])))
            .cast("bigint")
            .alias("n_stop_words"),
        ),
    )
    ratio = lambda a, b: F.when(F.col(f"_q.{b}") > 0, F.col(f"_q.{a}") / F.col(f"_q.{b}")).otherwise(0.0)
    return counts.withColumn(
        "_q",
        F.struct(
            "_q.*",
            ratio("word_chars", "n_words").alias("mean_word"),
            ratio("n_symbols", "n_words").alias("symbol_ratio"),
            ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
            ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ),
    ).drop("_text", "_words", "_lines", "_keys", "_windows", "_places")


def compiled(thresholds: tuple[Threshold, ...], measures: str = "_q") -> Column:
    """Names of the rules that a row breaks, as an array: empty if it passes."""
    broken = []
    for t in thresholds:
        value = F.col(f"{measures}.{t.measure}")
        out = F.lit(False)
        if t.least is not None:
            out = out | (value < t.least)
        if t.most is not None:
            out = out | (value > t.most)
        broken.append(F.when(out, F.lit(t.rule)))
    return F.array_compact(F.array(*broken))


def quality(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its counts, `base_failed`, `kept` and `broken` rules.

    base_failed: under 50 words, or over half of them in repeated windows. kept: neither
    base_failed nor any rule of the table broken. Null texts count as empty and fail; null or repeated
    ids keep their rows; other columns are ignored.
    """
    rows = with_measures(docs.select("doc_id", "text"), F.col("text"))
    rows = rows.select("doc_id", "_q", compiled(thresholds).alias("broken"))
    failed = (F.col("_q.n_words") < 50) | (100 * F.col("_q.n_repeat_words") > 50 * F.col("_q.n_words"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id",
        *(F.col(f"_q.{c}").alias(c) for c in counts),
        failed.alias("base_failed"),
        (~failed & (F.size("broken") == 0)).alias("kept"),
        "broken",
    )


def quality_sql(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> str:
    """The same result, without `broken`, in SQL over the table documents."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    ok = " AND ".join(
        f"{t.measure} {sign} {bound}"
        for t in thresholds
        for sign, bound in ((">=", t.least), ("<=", t.most))
        if bound is not None
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '{WORD}') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS t(k) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '{SYMBOL}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_intersect(list_transform(ws, lambda x: lower(x)), [{stops}])) AS n_stop_words
      FROM w LEFT JOIN c USING (rid)),
q AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
        CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {ok} AS kept FROM q"""
