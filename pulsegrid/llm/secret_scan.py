"""Secret scans by a trigram inverted index, in DataFrame expressions.

A rule is a regular expression. From each, a Boolean query of trigrams that every match must
contain is derived. The index holds, for the trigrams of these queries, the documents that
contain them; intersecting postings gives candidates, and only these are searched with the
expression. Rules without mandatory trigrams search every document.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser as syntax
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import BROADCAST_ROWS, materialise


class Rule(NamedTuple):
    """A match counts if the given group has at least so many characters; its span is the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in the order of the report. Runs that are too short are left out of the expressions
#: where that can't change what matches elsewhere.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Published formats of further secrets.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + FURTHER

#: Strings that a stretch of an expression may stand for, before it is cut.
STRINGS = 64
#: Matches whose places are summed up at a time.
BLOCK = 256

#: Characters of the parts in which a text is cut up.
PART = 1024
#: Spans that are put in order at a time.
SPANS = 64

Query = frozenset  # of conjunctions, each a frozenset of trigrams; the empty conjunction is always true
ANY: Query = frozenset([frozenset()])


def _simple(query: Query) -> Query:
    return frozenset(c for c in query if not any(o < c for o in query))


def _both(a: Query, b: Query) -> Query:
    return _simple(frozenset(x | y for x, y in product(a, b)))


def _contained(strings: set[str]) -> Query:
    """One of the strings is contained."""
    return _simple(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _sequence(items) -> tuple[set[str] | None, Query]:
    """What a sequence of an expression's nodes matches: its strings, if they are few, and a query."""
    whole, query, run = True, ANY, {""}
    for kind, value in items:
        strings, needed = _node(kind, value)
        if strings is not None and len(strings) * len(run) <= STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        query = _both(_both(query, _contained(run)), needed)
        whole, run = False, {""}
        if strings is not None:
            run = strings
            query = query if len(strings) <= STRINGS else _both(query, _contained(strings))
    return (run, _contained(run)) if whole else (None, _both(query, _contained(run)))


def _node(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
        return {chr(c).lower() for _, c in value}, ANY
    if kind is op.AT:
        return {""}, ANY
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        query = _simple(frozenset().union(*(q for _, q in parts)))
        exact = all(s is not None for s, _ in parts)
        return (set().union(*(s for s, _ in parts)) if exact else None), query
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        strings, query = _sequence(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        if low == high and strings is not None and len(strings) ** low <= STRINGS:
            return {"".join(p) for p in product(strings, repeat=low)}, ANY
        return None, query if low else ANY
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """Conjunctions of trigrams (lower case), one of which every text with a match contains."""
    return _sequence(syntax.parse(pattern))[1]


def _key() -> Column:
    # equal ids share postings: that can add candidates, not lose any
    return F.xxhash64("doc_id")


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings: `trigram` (its place in the list) and `key` of the documents that contain it in lower case."""
    rows = docs.select(_key().alias("key"), F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    return rows.select("key", F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """`key` and `rules` (array) of the documents that satisfy rules' queries."""
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    place = {t: i for i, t in enumerate(trigrams)}
    terms = [
        (place[t], rule, number, len(c))
        for rule, query in queries.items()
        for number, c in enumerate(sorted(query, key=sorted))
        for t in c
    ]
    # a row per trigram of a rule: as small as the rules
    wanted = docs.sparkSession.createDataFrame(terms, "trigram int, rule int, number int, need int")
    met = index(docs, trigrams).join(F.broadcast(wanted), "trigram").groupBy("key", "rule", "number", "need").count()
    return met.where("count = need").groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans (start, place of the rule, end) of a rule's matches, in code points.

    What stands between matches gives their places: sums of lengths, block by block.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    found = F.struct(
        between.alias("gaps"),
        F.transform(matches, F.char_length).alias("sizes"),
        F.transform(groups, F.char_length).alias("groups"),
    )
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def placed(m: Column) -> Column:
        steps = F.zip_with(m["gaps"], m["sizes"], lambda gap, size: gap + F.coalesce(size, F.lit(0)))
        blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
        bases = F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda acc, b: F.array_append(acc, F.element_at(acc, -1) + total(F.slice(steps, b * BLOCK + 1, BLOCK))),
        )
        known = F.struct(m["gaps"].alias("gaps"), m["sizes"].alias("sizes"), m["groups"].alias("groups"), steps.alias("steps"), bases.alias("bases"))
        return F.flatten(F.transform(F.array(known), each))

    def each(k: Column) -> Column:
        def span(size: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            inside = F.slice(k["steps"], block * BLOCK + 1, i % BLOCK)
            start = F.get(k["bases"], block) + total(inside) + F.get(k["gaps"], i)
            return F.when(
                F.get(k["groups"], i) >= rule.least,
                F.struct(start.alias("start"), F.lit(place).alias("rule"), (start + size).alias("end")),
            )

        return F.array_compact(F.transform(k["sizes"], span))

    # an array of one binds the lengths, so that they are found once
    return F.flatten(F.transform(F.array(found), placed))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with `_spans`: an array of (start, rule, end) by start, then rule, for every row.

    Offsets count code points, the end is exclusive; matches of a rule are leftmost and don't overlap. A null
    or empty text has no spans. Null and repeated ids keep their rows; all columns are kept, but
    none may be called _spans, _key or _rules.
    """
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    full = [i for i, q in queries.items() if q == ANY]
    found = materialise(candidates(docs, {i: q for i, q in queries.items() if i not in full}), "candidates")
    found = found.select(F.col("key").alias("_key"), F.col("rules").alias("_rules"))
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    each = []
    for i, rule in enumerate(rules):
        wanted = text.rlike(rule.pattern) if i in full else F.array_contains("_rules", i)
        each.append(F.when(wanted, _spans(text, rule, i)).otherwise(none))
    rows = docs.withColumn("_key", _key()).join(found, "_key", "left")
    return rows.withColumn("_spans", F.sort_array(F.concat(*each))).drop("_key", "_rules")


def _report(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.lit([r.kind for r in rules])
    text = lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, text), ",")


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """`doc_id`, the number of spans of each base kind (the first rules), `base_sha256` and `spans` of every row."""
    rows = scan(docs.select("doc_id", "text"), rules).select("doc_id", "_spans")
    of = lambda i: F.size(F.filter("_spans", lambda s: s["rule"] == i)).cast("bigint")
    based = F.filter("_spans", lambda s: s["rule"] < base)
    return rows.select(
        "doc_id",
        *(of(i).alias(f"n_{r.kind}") for i, r in enumerate(rules[:base])),
        F.sha2(_report(based, rules), 256).alias("base_sha256"),
        _report(F.col("_spans"), rules).alias("spans"),
    )


def _between(parts: Column, start: Column, end: Column) -> Column:
    """Characters [start, end) of a text in parts of PART characters."""
    first, last = F.floor(start / PART).cast("int"), F.floor(end / PART).cast("int")
    part = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    whole = F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    several = F.concat(F.substring(part(first), start % PART + 1, F.lit(PART)), whole, F.substring(part(last), F.lit(1), end % PART))
    return F.when(first == last, F.substring(part(first), start % PART + 1, end - start)).otherwise(several)


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of `text` replaced by a mark, overlapping spans by one; same rows and columns."""
    rows = scan(docs, rules)
    # spans ascend by start; in blocks, each gets the end of all before it, so no step copies a long list
    count = F.floor((F.size("_spans") - 1) / SPANS).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice("_spans", b * SPANS + 1, F.lit(SPANS)))
    rows = rows.withColumn("_blocks", F.when(F.size("_spans") > 0, blocks))
    furthest = F.transform("_blocks", lambda block: F.array_max(F.transform(block, lambda s: s["end"])))
    upto = F.aggregate(
        furthest, F.array(F.lit(0)), lambda acc, end: F.array_append(acc, F.greatest(F.element_at(acc, -1), end))
    )

    def gaps(block: Column, before: Column) -> Column:
        start = F.struct(before.alias("upto"), F.array().cast("array<struct<start:int,end:int>>").alias("gaps"))
        return F.aggregate(
            F.coalesce(block, F.array().cast("array<struct<start:int,rule:int,end:int>>")),
            start,
            lambda acc, s: F.struct(
                F.greatest(acc["upto"], s["end"]).alias("upto"),
                F.when(
                    s["start"] >= acc["upto"],
                    F.array_append(acc["gaps"], F.struct(acc["upto"].alias("start"), s["start"].alias("end"))),
                ).otherwise(acc["gaps"]).alias("gaps"),
            ),
            lambda acc: acc["gaps"],
        )

    rows = rows.withColumns({"_upto": upto, "_parts": F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))})
    found = F.flatten(F.zip_with("_blocks", "_upto", gaps))
    rest = F.array(F.struct(F.element_at("_upto", -1).alias("start"), F.char_length("text").alias("end")))
    # pieces are taken from short parts of the text: a place in a long one is found by counting from its front
    cut = F.array_join(F.transform(F.concat(found, rest), lambda g: _between(F.col("_parts"), g["start"], g["end"])), mark)
    clean = F.when(F.size("_spans") > 0, cut).otherwise(F.col("text"))
    return rows.withColumn("text", clean).select(docs.columns)


def report_sql(rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> str:
    """The report in SQL over the table documents."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    spans = " UNION ALL ".join(
        f"""SELECT rid, {i} AS rule, {quote(r.kind)} AS kind, unnest(range(1, len(ms) + 1)) AS i, ls, ms, gs, {r.least} AS least
FROM (SELECT rid, string_split_regex(text, {quote(r.pattern)}) AS ls, regexp_extract_all(text, {quote(r.pattern)}) AS ms,
regexp_extract_all(text, {quote(r.pattern)}, {r.group}) AS gs FROM d)"""
        for i, r in enumerate(rules)
    )
    counts = ", ".join(f"coalesce(n{i}, 0) AS n_{r.kind}" for i, r in enumerate(rules[:base]))
    sums = ", ".join(f"count(*) FILTER (WHERE rule = {i}) AS n{i}" for i in range(base))
    one = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({spans}),
p AS (SELECT rid, rule, kind, least, length(gs[i]) AS g, length(ms[i]) AS n,
        list_sum(list_transform(ls[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s FROM m),
q AS (SELECT rid, rule, kind, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e FROM p WHERE g >= least),
r AS (SELECT rid, {sums}, string_agg({one}, ',' ORDER BY s, rule) FILTER (WHERE rule < {base}) AS b,
        string_agg({one}, ',' ORDER BY s, rule) AS a FROM q GROUP BY rid)
SELECT doc_id, {counts}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN r USING (rid)"""
