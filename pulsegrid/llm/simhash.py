"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a point between them that is at most
r bits from either. Every fingerprint therefore emits all variants within r flipped bits; a
variant that two of them emit proves their link, and none can be missed. A ball of radius 2
in 64 bits has 2,081 variants. Fingerprints that cannot have a partner are found first by the
same scheme on two thirds of the bits, with balls of radius 1 (131 variants), and emit nothing
more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches
from pulsegrid.llm.components import connected_components
from pulsegrid.llm.decisions import content_key, with_verdicts
from pulsegrid.session import materialise

BITS = 64
#: Three blocks that cover the bits, as (first bit, bits).
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """64-bit SimHash of a text's word shingles, as a long.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Every
    shingle votes with its XXH64, repeats included; a text of fewer words votes whole. A bit is set by
    more than half of the votes. Null, empty and blank texts give 0.
    """

    @arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.cast(pa.binary())
            yield pa.array([_simhash(t.as_py() or b"", shingle, seed) for t in texts], pa.int64())

    return simhash(text)


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time (or one longer word)."""
    start = 0
    while start < len(data):
        end = start + PIECE
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end].lower().split()
        start = end


def _simhash(data: bytes, shingle: int, seed: int) -> int:
    votes, ones, tail = 0, np.zeros(BITS, np.int64), []
    for words in _pieces(data):
        words = tail + words
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)), strict=False)]
        tail = words[-(shingle - 1):] if shingle > 1 else []
        if grams:
            votes += len(grams)
            ones += _ones(grams, seed)
    if not votes and tail:
        votes, ones = 1, _ones([b" ".join(tail)], seed)
    bits = np.packbits(2 * ones > votes, bitorder="little")
    return int(bits.view(np.int64)[0])


def _ones(grams: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], np.uint64)
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _ball(bits: range | list[int], radius: int) -> list[int]:
    """Masks of at most `radius` of the bits."""
    return [
        _signed(sum(1 << b for b in some))
        for size in range(radius + 1)
        for some in combinations(bits, size)
    ]


def _with_partners(prints: DataFrame, distance: int) -> DataFrame:
    """The distinct fingerprints that may have a partner within `distance` bits.

    Of the three blocks one holds a third of the differing bits at least, so some two
    blocks differ in at most two thirds. Balls on those two blocks meet for every true
    pair; a fingerprint whose ball meets none is alone.
    """
    within = distance - -(-distance // len(BLOCKS))
    masks = []
    for out in range(len(BLOCKS)):
        bits = [b for i, (first, n) in enumerate(BLOCKS) if i != out for b in range(first, first + n)]
        whole = _signed(sum(1 << b for b in bits))
        masks += [(out, whole, flip) for flip in _ball(bits, -(-within // 2))]
    kinds = F.array(*(F.struct(F.lit(o).cast("byte").alias("out"), F.lit(w).alias("mask"), F.lit(f).alias("flip")) for o, w, f in masks))
    keys = _spread(prints.select("fp")).select("fp", F.explode(kinds).alias("k")).select(
        F.col("k.out").alias("out"), F.col("fp").bitwiseAND(F.col("k.mask")).bitwiseXOR(F.col("k.flip")).alias("key"), "fp"
    )
    row = Window.partitionBy("out", "key").orderBy("fp")
    # a fingerprint meets a key once: flips are distinct, so a neighbour row is another one
    near = keys.select("fp", (F.lag("fp").over(row).isNotNull() | F.lead("fp").over(row).isNotNull()).alias("met"))
    return near.where("met").select("fp").distinct()


def _spread(prints: DataFrame) -> DataFrame:
    """Small files, each row of which becomes many, on all tasks."""
    return prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs `a` < `b` of distinct fingerprints (`fp`, long) that connect all within `distance` bits.

    All fingerprints that emit a variant are within `distance` of each other when it is
    even, so a variant's members (2,081 at most) are chained, not paired: as many
    components as all pairs would give, in fewer rows. For odd distances the ball is one bit too wide and
    members are paired before the check, still within that bound.
    """
    some = materialise(_with_partners(prints, distance), "partners")
    ball = F.array(*(F.lit(m) for m in _ball(range(BITS), -(-distance // 2))))
    met = _spread(some).select("fp", F.explode(ball).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "fp"
    )
    row = Window.partitionBy("variant").orderBy("fp")
    if distance % 2 == 0:
        pairs = met.select(F.lag("fp").over(row).alias("a"), F.col("fp").alias("b")).where("a is not null")
    else:
        before = F.collect_list("fp").over(row.rowsBetween(Window.unboundedPreceding, -1))
        pairs = met.select(before.alias("a"), F.col("fp").alias("b")).select(F.explode("a").alias("a"), "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return pairs.distinct().where(near)


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` for every row of `docs`.

    Rows are linked when their fingerprints differ in at most `distance` bits;
    component_id is the smallest id reachable. Repeated rows and repeated ids stay, one
    row each. A null id keeps its row and is never a component_id unless a component has no
    other. Other columns are ignored, whatever their names. Null and empty texts share the fingerprint 0.
    """
    small_batches(docs.sparkSession)
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fp")), "simhash")
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = connected_components(links(prints.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    # rows of one fingerprint may be many: only that side grows, and skewed parts of it are split
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of each group of near-duplicates, all columns: that with the smallest id.

    Null ids come last; of rows with equal ids one is chosen by a key of its content, and of equal rows
    one is kept.
    """
    # the components' smallest member decides, so the order of these ids is the order of choice
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), content_key(docs).alias("key"))
    rows = docs.select(order.alias("id"), "text")
    members = materialise(near_duplicates(rows, shingle, distance, "id", "text"), "members")
    same = members.groupBy("doc_id", "component_id").agg(F.count("*").alias("rows"))
    first = F.col("doc_id.key") == F.col("component_id.key")
    odd = same.select(F.col("doc_id.key").alias("key"), first.alias("_first"), "rows")
    odd = odd.where(~F.col("_first") | (F.col("rows") > 1)).select("key", "_first")
    marked = with_verdicts(docs, odd)
    usual = marked.where(F.col("_first").isNull())
    repeated = marked.where("_first").dropDuplicates(["_key"])
    return usual.unionByName(repeated).select(docs.columns)
