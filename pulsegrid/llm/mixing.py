"""Mixing by soft membership.

A classifier learned from the labelled table gives every document a posterior over domains. Nonnegative
rates of documents are then fitted by projected gradient steps, so that the expected tokens
of each domain, sum of rate x tokens x posterior, meet the targets in the least-squares
sense. A step needs one small sum per domain over all documents; a document's rate follows from
the steps so far, so nothing but those sums is kept between steps.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.decisions import content_key, labelled_sample, with_verdicts
from pulsegrid.operators.joins import attach
from pulsegrid.operators.ordering import running_counts
from pulsegrid.session import materialise

#: Labelled rows from which the domains' words are learned, about: the first by a hash of their id.
SAMPLE = 20_000
#: Word beginnings per domain, at most: those with the strongest evidence.
MARKS = 200
#: Letters of a word's beginning.
LETTERS = 5
#: Gradient steps at most, and the relative error, or gain of a step, at which they end.
STEPS, TOLERANCE = 60, 1e-4
#: Relative distance of a domain's tokens from its target that is warned of.
MISSED = 0.05
#: Copies of equal rows that one task makes.
PORTION = 1_000

#: Domains of the labelled table, the first that holds.
DOMAINS = (("toxic", "toxic = 1"), ("low", "quality = 0"), ("good", "quality = 1"))
#: Shares of tokens wanted.
TARGETS = {"good": 0.97, "low": 0.02, "toxic": 0.01}

WORD = r"[^\x20\x09-\x0D]+"


class Model(NamedTuple):
    """Word beginnings by domain, and log-probabilities [domain][feature][bin] with priors [domain].

    `labelled` counts the rows that a domain was learned from. One without any takes no part, unless all are.
    """

    domains: list[str]
    labelled: list[int]
    marks: list[list[str]]
    priors: list[float]
    tables: list[list[list[float]]]


def labelled_domains(labels: DataFrame, domains=DOMAINS) -> DataFrame:
    """`doc_id`, `domain` of labelled rows: the first domain whose condition holds for any of an id's rows."""
    place = F.coalesce(*(F.when(F.expr(condition), F.lit(i)) for i, (_, condition) in enumerate(domains)))
    rows = labels.select("doc_id", place.alias("domain")).dropna()
    return rows.groupBy("doc_id").agg(F.min("domain").alias("domain"))


def _beginnings(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.substring(w, 1, LETTERS))


def _bin(value: Column, borders: tuple[float, ...]) -> Column:
    """Number of the borders that the value reaches."""
    return sum(((value >= b).cast("int") for b in borders), F.lit(0))


#: Borders of the bins of each feature: marks of a domain, then ratios.
MARK_BORDERS = (1, 2, 3, 5, 9)
RATIO_BORDERS = {"symbols": (0.02, 0.1, 0.5), "shouts": (0.02, 0.2), "capitals": (0.3, 0.6), "fresh": (0.2, 0.4, 0.6)}
BINS = 6


def features(docs: DataFrame, marks: list[list[str]]) -> DataFrame:
    """`key`, `doc_id`, `tokens` (words) and the binned features `f` (array) of every row; null texts are empty.

    key stands for the whole row.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(content_key(docs).alias("key"), "doc_id", text.alias("text"), _beginnings(text).alias("begins"))
    rows = rows.withColumn("distinct", F.array_distinct("begins"))
    n, letters = F.greatest(F.size("begins"), F.lit(1)), F.greatest(F.char_length("text"), F.lit(1))
    gone = lambda keep: F.char_length(F.regexp_replace("text", keep, ""))
    ratios = {
        "symbols": gone(r"[^#*$%&|<>]+") / n,
        "shouts": gone(r"[^!]+") / n,
        "capitals": gone(r"\P{Lu}+") / letters,
        "fresh": F.size("distinct") / n,
    }
    found = [
        _bin(F.size(F.array_intersect("distinct", F.lit(m))) if m else F.lit(0), MARK_BORDERS) for m in marks
    ] + [_bin(ratios[k], borders) for k, borders in RATIO_BORDERS.items()]
    return rows.select("key", "doc_id", F.size("begins").cast("bigint").alias("tokens"), F.array(*found).alias("f"))


def _learned_marks(docs: DataFrame, known: DataFrame, count: int, sample: int) -> list[list[str]]:
    """Word beginnings that are more frequent in a domain's labelled rows than chance allows."""
    chosen = labelled_sample(known, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    each = [F.sum((F.col("domain") == i).cast("bigint")).alias(f"d{i}") for i in range(count)]
    words = rows.select("domain", F.explode(F.array_distinct(_beginnings(F.col("text")))).alias("w"))
    counts = materialise(words.groupBy("w").agg(F.count("*").alias("n"), *each), "marks")
    totals = chosen.groupBy().agg(F.count("*").alias("n"), *each).first()
    chance = math.log(max(2, counts.count())) + 2
    marks = []
    for i in range(count):
        inside = totals[f"d{i}"] or 0
        if not 0 < inside < totals["n"]:
            marks.append([])
            continue
        share, here = inside / totals["n"], F.col(f"d{i}")
        rest = F.col("n") - here
        gain = here * F.log(here / (F.col("n") * share)) + F.when(
            rest > 0, rest * F.log(rest / (F.col("n") * (1 - share)))
        ).otherwise(0.0)
        lift = (here / inside) / F.greatest(rest / (totals["n"] - inside), F.lit(0.5 / totals["n"]))
        strong = counts.where((here > 0) & (gain > chance) & (lift > 4)).orderBy(gain.desc(), "w").limit(MARKS)
        marks.append([r["w"] for r in strong.collect()])
    return marks


def fit(docs: DataFrame, labels: DataFrame, domains=DOMAINS, sample: int = SAMPLE) -> tuple[Model, DataFrame]:
    """The classifier, and the features of all documents as a written table.

    Word beginnings come from about `sample` labelled rows; counts of binned features from all.
    """
    known = materialise(labelled_domains(labels, domains), "domains")
    marks = _learned_marks(docs, known, len(domains), sample)
    table = materialise(features(docs, marks), "features")
    cells = (
        table.join(known, "doc_id")
        .select("domain", F.posexplode("f").alias("feature", "bin"))
        .groupBy("domain", "feature", "bin")
        .count()
        .collect()  # at most domains x features x bins rows
    )
    count = {(r["domain"], r["feature"], r["bin"]): r["count"] for r in cells}
    width, kinds = len(marks) + len(RATIO_BORDERS), range(len(domains))
    totals = [sum(count.get((d, 0, b), 0) for b in range(BINS)) for d in kinds]
    tables = [
        [[math.log((count.get((d, f, b), 0) + 0.5) / (totals[d] + 0.5 * BINS)) for b in range(BINS)] for f in range(width)]
        for d in kinds
    ]
    some = any(totals)
    priors = [math.log((t + 1) / (sum(totals) + len(totals))) if t or not some else -math.inf for t in totals]
    return Model([name for name, _ in domains], totals, marks, priors, tables), table


def posteriors(table: DataFrame, model: Model) -> DataFrame:
    """`key`, `doc_id`, `tokens` and `p` (array, one share per domain) from a table of features."""
    score = lambda d: sum(
        (F.element_at(F.lit(cells), F.get("f", F.lit(i)) + 1) for i, cells in enumerate(model.tables[d])),
        F.lit(model.priors[d]),
    )
    rows = table.select("key", "doc_id", "tokens", F.array(*(score(d) for d in range(len(model.domains)))).alias("s"))
    rows = rows.withColumn("e", F.transform("s", lambda x: F.exp(x - F.array_max("s"))))
    whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return rows.select("key", "doc_id", "tokens", F.transform("e", lambda x: x / whole).alias("p"))


def _rates(steps: list[list[float]], count: int) -> Column:
    """A document's `rate` after the given steps, from 1, and `ahead`, the point of the next gradient.

    A step is a gradient per domain and the momentum after it. A rate moves against the gradient
    and is projected to 0 or more; the momentum carries it on.
    """
    one = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    if not steps:
        return one
    along = lambda g: sum((F.get("p", F.lit(d)) * F.get(g, F.lit(d)) for d in range(count)), F.lit(0.0))

    def step(now: Column, g: Column) -> Column:
        rate = F.greatest(F.lit(0.0), now["ahead"] - along(g))
        return F.struct(rate.alias("rate"), (rate + F.get(g, F.lit(count)) * (rate - now["rate"])).alias("ahead"))

    return F.aggregate(F.lit(steps), one, step)


class Fitted(NamedTuple):
    steps: list[list[float]]
    masses: list[float]
    targets: list[float]
    reached: list[float]


def token_targets(masses: list[float], weights: list[float], tokens: float | None = None, repeats: float = 1.0) -> list[float]:
    """Tokens wanted of each domain, given those it has.

    Without `tokens` the domain of the largest weight is kept whole, once, and sets the mixture's size (of
    several, the one that makes it largest); the others get what their weights say beside it. With
    `tokens` the targets add up to them, and the domain of the largest weight repeats if need be.
    No other domain is asked for more than `repeats` times what it has: what it lacks raises
    the shares of the rest in proportion, it never shrinks the rest. Domains without tokens take no part.
    """
    here = [d for d, (m, w) in enumerate(zip(masses, weights, strict=True)) if m > 0 and w > 0]
    targets = [0.0] * len(masses)
    if not here:
        return targets
    top = max(weights[d] for d in here)
    main = max((d for d in here if weights[d] == top), key=lambda d: masses[d])
    scale = masses[main] / top
    scarce: list[int] = []
    while tokens is not None:
        free = [d for d in here if d not in scarce]
        scale = (tokens - sum(repeats * masses[d] for d in scarce)) / sum(weights[d] for d in free)
        over = [d for d in free if d != main and weights[d] * scale > repeats * masses[d]]
        if not over:
            break
        scarce += over
    for d in here:
        targets[d] = weights[d] * scale if d == main else min(weights[d] * scale, repeats * masses[d])
    return targets


def fit_rates(table: DataFrame, weights: list[float], tokens: float | None = None, repeats: float = 1.0) -> Fitted:
    """Projected gradient steps for documents with `tokens` and `p`.

    Steps are accelerated by momentum, taken back when a step makes things worse. They end when every
    domain is met, or when no rates come nearer. The objective is the squared relative miss of each domain's expected tokens, in the metric of
    tokens; its largest curvature is 1, so a step length of 1 is safe. `tokens` and `repeats` are those of
    `token_targets`.
    """
    count = len(weights)
    expected = lambda rate: [
        F.coalesce(F.sum(rate * F.col("tokens") * F.get("p", F.lit(d))), F.lit(0.0)) for d in range(count)
    ]
    masses = list(table.agg(*(e.alias(f"d{d}") for d, e in enumerate(expected(F.lit(1.0))))).first())
    targets = token_targets(masses, weights, tokens, repeats)
    miss = lambda sums: [(r - t) / m if m > 0 else 0.0 for r, t, m in zip(sums, targets, masses, strict=True)]
    loss = lambda sums: sum(m * e * e for m, e in zip(masses, miss(sums), strict=True))
    steps: list[list[float]] = []
    reached, ahead, pace = masses, masses, 1.0
    while len(steps) < STEPS and max(map(abs, miss(reached)), default=0.0) > TOLERANCE:
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        steps.append([*miss(ahead), (pace - 1) / faster])
        sums = expected(_rates(steps, count)["rate"]) + expected(_rates(steps, count)["ahead"])
        found = list(table.agg(*(e.alias(f"s{i}") for i, e in enumerate(sums))).first())
        last, reached, ahead, pace = reached, found[:count], found[count:], faster
        if loss(reached) > loss(last):  # too much momentum: go on from here without
            steps[-1][-1], ahead, pace = 0.0, reached, 1.0
        elif loss(last) - loss(reached) <= TOLERANCE * loss(reached):
            break
    return Fitted(steps, masses, targets, reached)


def _fitted(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], tokens: float | None, domains, repeats: float) -> DataFrame:
    """Documents with their rates; warns of domains whose tokens stay away from what is wanted."""
    model, table = fit(docs, labels, domains)
    members = materialise(posteriors(table, model), "members")
    steps = []
    if any(model.labelled) or tokens is not None:  # else nothing tells domains apart, and all rows stay
        found = fit_rates(members, [targets[name] for name in model.domains], tokens, repeats)
        steps = found.steps
        missed = [
            f"{name}: {got:.4g} of {want:.4g}"
            for name, want, got, mass in zip(model.domains, found.targets, found.reached, found.masses, strict=True)
            if abs(got - want) > MISSED * max(want, TOLERANCE * mass)
        ]
        if missed:
            warnings.warn(f"expected tokens differ from the targets: {', '.join(missed)}", stacklevel=3)
    rows = members.withColumn("rate", _rates(steps, len(model.domains))["rate"])
    shares = [F.get("p", F.lit(d)).alias(f"p_{name}") for d, name in enumerate(model.domains)]
    return rows.select("key", "doc_id", "tokens", *shares, "rate")


def _rounded(rate: Column, chance: Column) -> Column:
    whole = F.floor(rate)
    return whole + (chance < rate - whole).cast("bigint")


def _chance(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 32)) / float(1 << 32)


def _repeated(rows: DataFrame) -> DataFrame:
    """Keys that several rows have: `key`, `n`, and the copies `total` of all of them, their rates rounded once."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.first("rate").alias("rate")).where("n > 1")
    total = _rounded(F.col("n") * F.col("rate"), _chance("key"))
    return sizes.select("key", "n", total.alias("total"))


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    tokens: float | None = None,
    domains=DOMAINS,
    repeats: float = 1.0,
) -> DataFrame:
    """`doc_id`, `tokens`, a posterior `p_<domain>` per domain, `rate` and `copies` for every row of `docs`.

    copies is the rate rounded up or down by a hash of the whole row, so that it is the rate on
    average. Rows that are equal in all columns are rounded together, and each gets its share of their copies or one more.
    Null texts have no tokens; labels of null ids and labels
    that name no domain are left out; a domain that no label names has the posterior 0; without labels all
    posteriors are equal and, with `tokens` unset, all rates 1. Sizes are those of `token_targets`: the domain of the
    largest target is kept whole, and a scarce one is kept as it is. Other columns count in the rounding alone.
    """
    rows = _fitted(docs, labels, targets, tokens, domains, repeats)
    alone = _rounded(F.col("rate"), _chance("key"))
    repeated = materialise(_repeated(rows), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("copies", alone).drop("key")
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "rates")
    found = attach(rows, repeated, ["key"], spread_by=["_row"])
    several = running_counts(found.where("n IS NOT NULL"), ["key"], ["_row"], {"_number": F.lit(True)})
    more = (F.col("_number") <= F.col("total") % F.col("n")).cast("bigint")
    several = several.withColumn("copies", F.floor(F.col("total") / F.col("n")) + more)
    both = found.where("n IS NULL").withColumn("copies", alone).unionByName(several.drop("_number"))
    return both.drop("key", "n", "total", "_row")


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    tokens: float | None = None,
    domains=DOMAINS,
    repeats: float = 1.0,
) -> DataFrame:
    """The mixture: every row of `docs`, all columns, as often as its `copies` say.

    Ids, null ones too, play no part but as content. Rows that are equal in all columns come out as
    often as their rates add up to.
    """
    rows = _fitted(docs, labels, targets, tokens, domains, repeats)
    repeated = materialise(_repeated(rows), "repeated")
    copies = rows.select("key", _rounded(F.col("rate"), _chance("key")).alias("copies"), F.lit(None).cast("bigint").alias("total"))
    if repeated.isEmpty():
        listed = copies.where("copies <> 1")
    else:  # as many copies as there are rows: they stay as they are
        listed = attach(copies.drop("total"), repeated.drop("n"), ["key"], spread_by=["key"]).distinct()
        listed = listed.where("total IS NOT NULL OR copies <> 1")
    listed = listed.select("key", F.col("copies").cast("int").alias("_copies"), F.col("total").alias("_total"))
    verdicts = with_verdicts(docs, listed)
    times = F.array_repeat(F.lit(0), F.coalesce("_copies", F.lit(1)))
    out = verdicts.where("_total IS NULL").withColumn("_copy", F.explode(times)).select(docs.columns)
    if repeated.isEmpty():
        return out
    # one row stands for the equal ones; its copies are made in portions, each by another task
    one = verdicts.where("_total > 0").dropDuplicates(["_key"])
    last = F.floor((F.col("_total") - 1) / PORTION)
    portions = one.withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    portions = portions.repartition("_key", "_portion")
    size = F.least(F.lit(PORTION), F.col("_total") - F.col("_portion") * PORTION).cast("int")
    return out.unionByName(portions.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), size))).select(docs.columns))
