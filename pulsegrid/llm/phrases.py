"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are cut into short blocks whose borders depend on a few neighbouring
symbols only; every block gets a name that is a hash of its content, and the names are parsed
again, level by level. Equal substrings get equal names inside, wherever they stand. Borders are local
maxima of labels found by deterministic coin tossing: a symbol's label is the place and value of the
lowest bit in which it differs from its left neighbour, repeated until six labels are left.
A fingerprint is a min-hash sketch of the phrase names. A run of one symbol goes on as one symbol, so it
also counts as as many numbered phrases as its bytes would make: what it holds weighs as much as other text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches

#: Phrases of this level and above (about 27 bytes) describe a long text.
COARSE_LEVEL = 3
#: A short text with fewer coarse phrases is compared by its phrases of every level.
FEW = 16
#: Bytes of a run that count as a phrase of the coarse and of the fine sketch.
COARSE_STEP, FINE_STEP = 27, 3
#: Texts up to so many bytes carry the fine sketch too, those up to TINY also single symbols.
SHORT, TINY = 2048, 32
SLOTS = 64
#: Bytes of text parsed together.
CHUNK = 1 << 20
#: Symbols whose block hashes are made together.
SLICE = 1 << 20

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _MIX
    return x ^ (x >> _U(32))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, _U(0x2545F4914F6CDD1D)))


_BYTE_NAMES = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX)
_MIXED_BYTES = _mixed(_BYTE_NAMES)
_WEIGHTS = _powers(64)
_SLOT = _mixed(np.arange(1, SLOTS + 1, dtype=np.uint64)) | _U(1)


def _labels(names: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Labels below six, different for neighbours, from names different for neighbours."""
    bound = 256 if names.dtype == np.uint8 else 1 << 64
    while bound > 6:
        one = names.dtype.type(1)
        differ = np.empty_like(names)
        differ[1:] = names[1:] ^ names[:-1]
        differ[firsts] = one  # a text's first symbol has no left neighbour
        lowest = differ & (~differ + one)
        place = np.bitwise_count(lowest - one).astype(np.uint8)
        value = ((names & lowest) != 0).view(np.uint8)
        names = (place << np.uint8(1)) | value
        bound = 2 * max(3, (bound - 1).bit_length())
    return names


def _blocks(labels: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where blocks start: at every text's first symbol and at local maxima."""
    peak = np.zeros(len(labels), bool)
    if len(labels) > 2:
        peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
        last = firsts[1:] - 1
        peak[last] = False
    peak[firsts] = True
    return np.flatnonzero(peak)


def _named(names: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """Names of blocks: hashes of their symbols in order, some blocks at a time."""
    out = np.empty(len(starts), np.uint64)
    ends = np.append(starts[1:], len(names))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE)))
        lo, hi = starts[at], ends[to - 1]
        local = starts[at:to] - lo
        place = np.arange(hi - lo) - np.repeat(local, ends[at:to] - starts[at:to])
        part = names[lo:hi]
        part = _MIXED_BYTES[part] if part.dtype == np.uint8 else _mixed(part)
        out[at:to] = np.add.reduceat(part * _WEIGHTS[np.minimum(place, 63)], local)
        at = to
    return _mixed(out + _U(level * int(_MIX) % (1 << 64)))


def _runs(names: np.ndarray, firsts: np.ndarray):
    """Repeats of one symbol as one symbol: (symbols, their names with the repeat, firsts, where they start)."""
    new = np.empty(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[firsts] = True
    if new.all():
        return names, None, firsts, None
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(names))).astype(np.uint64)
    symbols = names[starts]
    whole = _BYTE_NAMES[symbols] if symbols.dtype == np.uint8 else symbols
    whole = np.where(count > 1, _mixed(whole + count * _MIX), whole)
    return symbols, whole, np.searchsorted(starts, firsts), starts


def phrases(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level (0: symbols): the names of phrases, where each text's begin, and which texts they are.

    `texts` are not empty. A text that has become one phrase is in no further level, whatever the others.
    """
    return (found for found in _levels(texts) if found[0] is not None)


def _levels(texts: list[bytes]) -> Iterator[tuple[int | None, np.ndarray, np.ndarray, np.ndarray]]:
    """As `phrases`; and, with None for the level, runs: names without the repeat, bytes, and texts (ascending)."""
    lengths = np.array([len(t) for t in texts])
    firsts = np.cumsum(lengths) - lengths
    names = np.frombuffer(b"".join(texts), np.uint8)
    which = np.arange(len(texts))
    at, stops = np.arange(len(names)), firsts + lengths  # bytes where symbols start and texts end
    level = 0
    while len(which):
        symbols, whole, firsts, starts = _runs(names, firsts)
        if starts is not None:
            repeats = np.diff(np.append(starts, len(names))) > 1
            at = at[starts]
            ends = np.append(at[1:], 0)
            ends[np.append(firsts[1:], len(at)) - 1] = stops[which]
            run = np.flatnonzero(repeats)
            found = symbols[run]
            found = _BYTE_NAMES[found] if found.dtype == np.uint8 else found
            yield None, found, ends[run] - at[run], which[np.searchsorted(firsts, run, side="right") - 1]
        if level == 0:
            yield 0, _BYTE_NAMES[symbols] if whole is None else whole, firsts, which
        count = np.diff(np.append(firsts, len(symbols)))
        going = count > 1
        if not going.all():
            stay = np.repeat(going, count)
            symbols, whole, at = symbols[stay], None if whole is None else whole[stay], at[stay]
            which, count = which[going], count[going]
            firsts = np.cumsum(count) - count
            if not len(which):
                return
        starts = _blocks(_labels(symbols, firsts), firsts)
        level += 1
        names, at = _named(symbols if whole is None else whole, starts, level), at[starts]
        firsts = np.searchsorted(starts, firsts)
        yield level, names, firsts, which


def _least(names: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.stack([np.minimum.reduceat(names * m, firsts) for m in _SLOT], axis=1)


def _numbered(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`counts` names for each name, the first ones of a longer run those of a shorter."""
    place = np.arange(1, counts.sum() + 1) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(np.repeat(_mixed(names), counts) + place.astype(np.uint64) * _MIX)


def _add_runs(sketch: np.ndarray, names: np.ndarray, counts: np.ndarray, which: np.ndarray) -> None:
    some = counts > 0
    if some.any():
        counts, which = counts[some], which[some]
        new = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
        rows = which[new]
        sketch[rows] = np.minimum(sketch[rows], _least(_numbered(names[some], counts), (np.cumsum(counts) - counts)[new]))


def _sketches(texts: list[bytes]) -> list[str]:
    """Fingerprints of texts that are not empty."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts])
    short, tiny = lengths <= SHORT, lengths <= TINY
    none = np.iinfo(np.uint64).max
    coarse, fine = np.full((n, SLOTS), none), np.full((n, SLOTS), none)
    many = np.zeros(n, np.int64)
    for level, names, firsts, which in _levels(texts):
        if level is None:
            extent = firsts
            coarse_runs = extent // COARSE_STEP
            np.add.at(many, which, coarse_runs)
            _add_runs(coarse, names, coarse_runs, which)
            _add_runs(fine, names, np.where(short[which], extent // FINE_STEP, 0), which)
            continue
        count = np.diff(np.append(firsts, len(names)))
        if level >= COARSE_LEVEL:
            many[which] += count
            coarse[which] = np.minimum(coarse[which], _least(names, firsts))
        some = (short if level else tiny)[which]
        if some.any():
            kept = names[np.repeat(some, count)]
            begins = np.cumsum(count[some]) - count[some]
            fine[which[some]] = np.minimum(fine[which[some]], _least(kept, begins))
    kinds = np.where(many >= FEW, 1, 0) + np.where(short, 2, 0)
    slots = [(_mixed(x) >> _U(48)).astype(">u2") for x in (coarse, fine)]
    return [
        f"{k:02x}" + (c.tobytes().hex() if m else "0" * 4 * SLOTS) + (f.tobytes().hex() if s else "")
        for k, c, f, m, s in zip(kinds, *slots, many, short, strict=True)
    ]


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of texts: hex digits; the empty text's is empty."""
    out = [""] * len(texts)
    rows: list[int] = []
    data: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        if text:
            rows.append(i)
            data.append(text.encode())
            size += len(data[-1])
        if rows and (size >= CHUNK or i == len(texts) - 1):
            for row, found in zip(rows, _sketches(data), strict=True):
                out[row] = found
            rows, data, size = [], [], 0
    return out


def similarity(a: str, b: str) -> float:
    """Share of two texts' phrases that they have in common, estimated, from 0 to 1.

    Two short texts that do not both have FEW coarse phrases are compared by all phrases, others by
    coarse ones. Two empty texts are alike, an empty text is like no other.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    kinds = int(a[:2], 16) & int(b[:2], 16)
    at = 2 if kinds & 1 or not kinds & 2 else 2 + 4 * SLOTS
    x, y = a[at:at + 4 * SLOTS], b[at:at + 4 * SLOTS]
    if x == "0" * len(x) or y == "0" * len(y):
        return 0.0
    jaccard = np.mean(np.frombuffer(bytes.fromhex(x), ">u2") == np.frombuffer(bytes.fromhex(y), ">u2"))
    return float(2 * jaccard / (1 + jaccard))


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column; null counts as empty, whose fingerprint is ''."""

    @arrow_udf("string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(fingerprints([t or "" for t in batch.to_pylist()]), pa.string())

    return found(text)


def likeness(a: Column, b: Column) -> Column:
    """`similarity` of two fingerprint columns; null where one is null."""

    @arrow_udf("double")
    def found(x: pa.Array, y: pa.Array) -> pa.Array:
        pairs = zip(x.to_pylist(), y.to_pylist(), strict=True)
        return pa.array([None if p is None or q is None else similarity(p, q) for p, q in pairs], pa.float64())

    return found(a, b)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
#: Documents whose texts are held together by a task, in characters.
HELD = 1 << 20


def edited_fingerprints(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Each document's fingerprint, that of an edited text, and how near they are.

    The edited text has its last third (rounded down, in code points) replaced by as many
    first code points of the next document in descending doc_id, or all it has; after the last comes the
    first. Equal ids follow by descending text, null ids come last; a null text is empty; a single
    document follows itself. One row per input row; other columns are ignored. With
    `keep_text` the column `edited` holds the edited text.

    Documents are dealt out once, by ranges of doc_id, and streamed in order; the first
    document of a range goes to the range before as well. The driver sees range borders only.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / (4 * tasks) for i in range(1, 4 * tasks)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 100 * len(shares))).first()[0] or []
    borders = np.array(sorted(set(found)), np.int64)

    @arrow_udf("int")
    def part(ids: pa.Array) -> pa.Array:
        # descending: the largest ids are part 0, nulls go with the smallest
        known = np.asarray(ids.fill_null(np.iinfo(np.int64).min))
        return pa.array(len(borders) - np.searchsorted(borders, known, side="right"), pa.int32())

    placed = docs.withColumn("part", part("doc_id"))
    heads = sorted((r["part"], r["head"]) for r in placed.groupBy("part").agg(F.max("doc_id").alias("head")).collect())
    # (document, the part that peeks at it); the first document follows the very last one
    peeks = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    peek = spark.createDataFrame(peeks, "head long, to int")
    ahead = docs.join(F.broadcast(peek), F.col("doc_id").eqNullSafe(F.col("head")))
    rows = placed.withColumn("peek", F.lit(0)).unionByName(ahead.select("doc_id", "text", F.col("to").alias("part"), F.lit(1).alias("peek")))
    ordered = rows.repartition(tasks, "part").sortWithinPartitions(
        "part", "peek", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (id, text, next text)
        size, last = 0, None
        for batch in batches:
            cells = zip(*(batch.column(c) for c in ("part", "peek", "doc_id", "text")), strict=True)
            for row in cells:
                here, ahead, doc, text = (x.as_py() for x in row)
                if last and last[0] == here:
                    held.append((*last[1:], text))
                    size += len(last[2])
                last = None if ahead else (here, doc, text)
                if size >= HELD:
                    yield _compared(held, keep_text)
                    held, size = [], 0
        if held:
            yield _compared(held, keep_text)

    return ordered.mapInArrow(stream, SCHEMA + (", edited string" if keep_text else ""))


def _compared(rows: list[tuple], keep_text: bool) -> pa.RecordBatch:
    edited = []
    for _, text, after in rows:
        cut = len(text) // 3
        edited.append(text[:len(text) - cut] + after[:cut])
    # the next text is mostly the next row's own
    follows = [i + 1 < len(rows) and rows[i][2] is rows[i + 1][1] for i in range(len(rows))]
    prints = fingerprints([r[1] for r in rows])
    others = iter(fingerprints([r[2] for r, own in zip(rows, follows, strict=True) if not own]))
    after = [prints[i + 1] if own else next(others) for i, own in enumerate(follows)]
    edits = fingerprints(edited)
    columns = [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array(prints, pa.string()),
        pa.array(edits, pa.string()),
        pa.array([similarity(a, b) for a, b in zip(prints, edits, strict=True)]),
        pa.array([similarity(a, b) for a, b in zip(prints, after, strict=True)]),
    ]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    if keep_text:
        columns, names = [*columns, pa.array(edited, pa.string())], [*names, "edited"]
    return pa.RecordBatch.from_arrays(columns, names)
