"""Two tokenizers' tokens of the same texts, aligned, and how many documents link each pair of ids.

Texts are tokenised once, in packs, and cut where tokens of both end at the same byte. The distinct
linked pairs of ids fall into buckets by their first id; unions of pairs go up a tree, and the last
union of a bucket gets a minimal perfect hash. Packs then add their documents to dense vectors
indexed by it (keys are verified), vectors are summed up a tree, and each pack gets the counts of its own
pairs back and aligns its documents again. No task holds more than a bucket's pairs, whose number
the two vocabularies bound, and TREE vectors of that length; a pack is aligned a portion of its documents at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsegrid.llm.batches import small_batches, small_bytes
from pulsegrid.llm.packs import PACK_BYTES, gathered, rows, squeezed, unsqueezed
from pulsegrid.llm.perfect_hash import PerfectHash
from pulsegrid.session import materialise

#: Buckets that the first ids are dealt to, and children of a node when vectors are summed.
BUCKETS, TREE = 256, 64
#: Pairs of tokens that are written out at a time. A group with more links is counted by its distinct ids.
LINKS = 1 << 16
#: Tokens of both kinds in a portion of a pack, roughly; a longer document is a portion of its own.
PORTION = 1 << 17
#: Bytes of packs that Spark hands to a task's Python at a time: a pack with its pairs is some megabytes.
HANDED = 4 << 20

#: Blanks in a row that tiktoken's expressions run out of stack at; the slower tokenizers library takes such texts.
BLANKS = re.compile(r"\s{20000}")

TOKENS = pa.schema(
    [("ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary())]
)
PAIRS = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary())])
ANSWERS = pa.schema([("pack", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
OUT = pa.schema(
    [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups", pa.string())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    of = lambda t: f"array<{of(t.value_type)}>" if pa.types.is_list(t) else names[t]
    return ", ".join(f"{f.name} {of(f.type)}" for f in schema)


# ---- vocabularies -------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in plain)
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def byte_vocabulary(tokenizer: str) -> list[bytes]:
    """Bytes of the ids of a byte-level BPE file (its text) whose merges are listed in the order of their ids."""
    model = json.loads(tokenizer)["model"]
    letters = _byte_letters()
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != [*range(256, 256 + len(merged))]:
        raise ValueError("ids do not follow the merges")
    by_id = sorted((i, t) for t, i in model["vocab"].items() if i < 256 + len(merged))
    return [bytes(letters[c] for c in t) for _, t in by_id]


def piece_vocabulary(model: bytes) -> list[bytes]:
    """Bytes of the ids of a sentencepiece model: U+2581 is a blank, <0xHH> a byte."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(pieces.get_piece_size())
    return [
        bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
        for i in ids
    ]


class ByteTokens:
    """Ids of a byte-level BPE file, by tiktoken where it can."""

    def __init__(self, tokenizer: str, vocabulary: list[bytes], pattern: str):
        self.tokenizer, self.slow = tokenizer, None
        ranks = {t: i for i, t in enumerate(vocabulary)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if not BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            self.slow = Tokenizer.from_str(self.tokenizer)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: they are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _kind(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


# ---- a pack -------------------------------------------------------------


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] + np.uint64(1)) != 0]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Aligned:
    """Groups and links of some documents: the token ids of all of them in a row, and their numbers per document."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a.astype(np.int64), b.astype(np.int64), n_a, n_b
        self.width = size_b.size
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        marks = np.zeros(int(ends_a[-1]) + 1 if a.size else 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] += 2
        self.last_a, self.last_b = marks[ends_a] == 3, marks[ends_b] == 3
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        # tokens of either side in a group, and the document of a group
        self.in_a, self.in_b = np.bincount(self.group_a), np.bincount(self.group_b)
        self.doc = np.repeat(np.arange(n_a.size), n_a)[self.last_a]
        self.n_groups = np.bincount(self.doc, minlength=n_a.size)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, key, times) of linked pairs of ids, in the order of documents, in bounded portions."""
        n = self.in_a * self.in_b
        large = np.flatnonzero(n > LINKS)
        first_a, first_b = _starts(self.in_a), _starts(self.in_b)
        at = 0
        for stop in [*large.tolist(), n.size]:
            yield from self._small(at, stop, n, first_a, first_b)
            if stop < n.size:
                yield from self._large(stop, first_a[stop], first_b[stop])
            at = stop + 1

    def _small(self, at: int, stop: int, n: np.ndarray, first_a: np.ndarray, first_b: np.ndarray):
        upto = np.cumsum(n[at:stop])
        while at < stop:
            base = upto[-(stop - at)] - n[at]
            cut = max(at + 1, stop - upto.size + int(np.searchsorted(upto, base + 2 * LINKS)))
            mine = slice(first_a[at], first_a[cut - 1] + self.in_a[cut - 1])
            a, group = self.a[mine], self.group_a[mine]
            times = self.in_b[group]
            own = np.repeat(np.arange(a.size), times)
            other = np.arange(own.size) - np.repeat(_starts(times), times) + np.repeat(first_b[group], times)
            yield self.doc[group[own]], a[own] * self.width + self.b[other], np.ones(own.size, np.int64)
            at = cut

    def _large(self, group: int, first_a: int, first_b: int):
        a, times_a = np.unique(self.a[first_a:first_a + self.in_a[group]], return_counts=True)
        b, times_b = np.unique(self.b[first_b:first_b + self.in_b[group]], return_counts=True)
        step = max(1, LINKS // b.size)
        for i in range(0, a.size, step):
            keys = (a[i:i + step, None] * self.width + b).ravel()
            yield np.full(keys.size, self.doc[group]), keys, (times_a[i:i + step, None] * times_b).ravel()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, ascending, and how many documents hold each."""
        found, more = np.zeros(0, np.uint64), []
        for doc, key, _ in self.links():
            more.append(_distinct(doc.astype(np.uint64) << np.uint64(32) | key.astype(np.uint64)))
            if sum(m.size for m in more) > max(found.size, 4 * LINKS):
                found, more = _distinct(np.concatenate([found, *more])), []
        found = _distinct(np.concatenate([found, *more]))
        held = np.sort((found & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        first = np.flatnonzero(np.diff(held, prepend=held[:1] + np.uint32(1)))
        return held[first], np.diff(first, append=held.size)

    def sums(self, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> list[np.ndarray]:
        """n_links, n_best and count_sum of each document, by ascending keys, all of its own among them, and their counts."""
        totals = [np.zeros(self.n_a.size, np.int64) for _ in range(3)]
        for doc, key, times in self.links():
            at = np.searchsorted(keys, key)
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            for total, values in zip(totals, (times, times * best[at], times * counts[at]), strict=True):
                total[doc[starts]] += np.add.reduceat(values, starts) if starts.size else 0
        return totals

    def texts(self, written: list[bytes]) -> Iterator[str]:
        """Groups of each document as text; `written` has the ids of a before ',' and '|', of b before ',' and ';'."""
        a, b = self.a.size, self.b.size
        size_a = (len(written) - 2 * self.width) // 2
        order = np.zeros(a + b, np.int64)
        order[np.arange(a) + _starts(self.in_b)[self.group_a]] = self.a + self.last_a * size_a
        order[np.arange(b) + np.cumsum(self.in_a)[self.group_b]] = self.b + self.last_b * self.width + 2 * size_a
        at = 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join(map(written.__getitem__, order[at:at + n].tolist()))[:-1].decode()
            at += n


def portions(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Iterator[Aligned]:
    """The documents of a pack in their order, about PORTION tokens at a time."""
    upto, ends_a, ends_b = (np.cumsum(n) for n in (n_a + n_b, n_a, n_b))
    at = first_a = first_b = 0
    while at < n_a.size:
        cut = max(at + 1, int(np.searchsorted(upto, first_a + first_b + PORTION, side="right")))
        last_a, last_b = int(ends_a[cut - 1]), int(ends_b[cut - 1])
        yield Aligned(a[first_a:last_a], b[first_b:last_b], n_a[at:cut], n_b[at:cut], size_a, size_b)
        at, first_a, first_b = cut, last_a, last_b


def pack_pairs(parts: Iterator[Aligned], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all parts, ascending by bucket and key, and how many documents hold each."""
    keys, docs = (np.concatenate(c) for c in zip(*(p.pairs() for p in parts), strict=True))
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint32(1)))
    keys, docs = keys[first], np.add.reduceat(docs, first) if first.size else docs
    order = np.argsort(bucket(keys.astype(np.int64), width), kind="stable")
    return keys[order], docs[order]


def bucket(keys: np.ndarray, width: int) -> np.ndarray:
    return keys // width % BUCKETS


def _packed(keys: np.ndarray) -> bytes:
    """Ascending keys, by their differences."""
    return squeezed(np.diff(keys.astype(np.uint32), prepend=np.uint32(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(data, np.uint32), dtype=np.uint32)


def _written(size_a: int, size_b: int) -> list[bytes]:
    return [b"%d%s" % (i, end) for n, ends in ((size_a, b",|"), (size_b, b",;")) for end in (ends[:1], ends[1:]) for i in range(n)]


# ---- Spark --------------------------------------------------------------


def _tokenised(docs: DataFrame, tokenizer: str, a: list[bytes], pattern: str, model: bytes, b: list[bytes]) -> DataFrame:
    """Packs of token ids, written once: pack, ids, n_a, n_b (per document), a, b."""
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, a, pattern, model, b))
    kind_a, kind_b = _kind(len(a)), _kind(len(b))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, bytes_a, pattern, model, bytes_b = shared.value
        first = ByteTokens(tokenizer, bytes_a, pattern)
        second = sentencepiece.SentencePieceProcessor(model_proto=model)
        for ids, texts in gathered(batches, PACK_BYTES):
            found = []
            for text in texts:
                plain = text.decode("utf-8")
                x = first(" " + plain) if plain else []
                y = second.encode(plain, num_threads=1) if plain else []
                whole = b" " + text
                if b"".join(map(bytes_a.__getitem__, x)) != whole or b"".join(map(bytes_b.__getitem__, y)) != whole:
                    x, y = [], []
                found.append((np.array(x, kind_a), np.array(y, kind_b)))
            sides = [*zip(*found, strict=True)]
            yield rows(TOKENS, [(ids, *([len(t) for t in s] for s in sides), *(squeezed(np.concatenate(s)) for s in sides))])

    source = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    packs = source.mapInArrow(tokenise, _ddl(TOKENS))
    return materialise(packs.withColumn("pack", F.monotonically_increasing_id()), "tokens")


def _climb(parts: DataFrame, n: int, join: Callable[[pa.Table], bytes], last: pa.Schema, finish: Callable[[int, bytes], tuple]) -> DataFrame:
    """One row a bucket of rows (bucket, part, value) in `n` parts: TREE parts are joined at a time.

    `finish` makes the row of `last` in the task of the last union: an operator of its own would need a second Python process beside it.
    """
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("value", pa.binary())])

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([rows(schema, [(key[0].as_py(), key[1].as_py(), join(group))])])

    def end(key: tuple, group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([rows(last, [finish(key[0].as_py(), join(group))])])

    while (n := -(-n // TREE)) > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / TREE)).groupBy("bucket", "part").applyInArrow(merge, _ddl(schema))
    return parts.groupBy("bucket").applyInArrow(end, _ddl(last))


def _counted(pairs: DataFrame, n_packs: int, width: int) -> DataFrame:
    """Counts of the pairs of every pack: rows of `pack`, `keys`, `counts`, `best` in the order of the keys."""
    parts = -(-n_packs // TREE)
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(parts)))
    hashed = pa.schema([("bucket", pa.int32()), ("hash", pa.binary()), ("keys", pa.binary())])

    def union(group: pa.Table) -> bytes:
        found = [_unpacked(k) for k in group.column("value").to_pylist()]
        return _packed(np.unique(np.concatenate(found)))

    def number(bucket: int, data: bytes) -> tuple:
        keys = _unpacked(data)
        function = PerfectHash.build(keys)
        placed = np.empty_like(keys)
        placed[function(keys)] = keys
        return bucket, function.dump(), squeezed(placed)

    # rows of a part are joined first, then TREE parts at a time
    keysets = dealt.select("bucket", (F.col("part") * TREE).alias("part"), F.col("keys").alias("value"))
    hashes = materialise(_climb(keysets, parts * TREE, union, hashed, number), "hashes")
    every_part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part")

    def numbers(function: PerfectHash, known: np.ndarray, keys: np.ndarray) -> np.ndarray:
        places = function(keys)
        if not np.array_equal(known[places], keys):
            raise ValueError("a pair that no pack had")
        return places

    vectors = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("value", pa.binary())])

    def vector(key: tuple, mine: pa.Table, table: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return pa.Table.from_batches([rows(vectors, [])])
        function = PerfectHash.load(table.column("hash")[0].as_py())
        known = unsqueezed(table.column("keys")[0].as_py(), np.uint32)
        dense = np.zeros(known.size, np.int64)
        for keys, docs in zip(mine.column("keys").to_pylist(), mine.column("docs").to_pylist(), strict=True):
            dense[numbers(function, known, _unpacked(keys))] += unsqueezed(docs, np.uint32)
        return pa.Table.from_batches([rows(vectors, [(key[0].as_py(), key[1].as_py(), squeezed(dense))])])

    def add(group: pa.Table) -> bytes:
        return squeezed(sum(unsqueezed(v, np.int64) for v in group.column("value").to_pylist()))

    by_part = lambda df: df.groupBy("bucket", "part")
    dense = by_part(dealt).cogroup(by_part(hashes.select("*", every_part))).applyInArrow(vector, _ddl(vectors))
    summed = pa.schema([("bucket", pa.int32()), ("vector", pa.binary())])
    sums = _climb(dense, parts, add, summed, lambda bucket, data: (bucket, data))
    table = materialise(hashes.join(sums, "bucket"), "counts")

    def look_up(mine: pa.Table, table: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return pa.Table.from_batches([rows(ANSWERS, [])])
        row = table.to_pylist()[0]
        function, known = PerfectHash.load(row["hash"]), unsqueezed(row["keys"], np.uint32)
        counts = unsqueezed(row["vector"], np.int64)
        _, first = np.unique(known // width, return_inverse=True)
        most = np.zeros(known.size, np.int64)
        np.maximum.at(most, first, counts)
        best = counts == most[first]
        out = []
        for pack, keys in zip(mine.column("pack").to_pylist(), mine.column("keys").to_pylist(), strict=True):
            places = numbers(function, known, _unpacked(keys))
            out.append((pack, keys, squeezed(counts[places]), squeezed(np.packbits(best[places]))))
        return pa.Table.from_batches([rows(ANSWERS, out)])

    return by_part(dealt).cogroup(by_part(table.select("*", every_part))).applyInArrow(look_up, _ddl(ANSWERS))


def aligned_documents(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """A row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (text).

    `byte_path` is a byte-level BPE file (a), whose words `pattern` finds, `piece_path` a sentencepiece model
    (b) that puts a blank before a text; a reads the blank too. The library tiktoken merges by the ids of the
    file, which are its merges in order. A null or empty text, and one whose tokens don't add up to its bytes,
    has no tokens: zeros and ''. Null and repeated ids keep their rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    small_bytes(docs.sparkSession, HANDED)
    with open(byte_path, encoding="utf-8") as file:
        tokenizer = file.read()
    bytes_a = byte_vocabulary(tokenizer)
    with open(piece_path, "rb") as file:
        model = file.read()
    bytes_b = piece_vocabulary(model)
    size_a, size_b = (np.array([len(t) for t in v]) for v in (bytes_a, bytes_b))
    kind_a, kind_b, width = _kind(len(bytes_a)), _kind(len(bytes_b)), len(bytes_b)
    if len(bytes_a) * width >= 1 << 32:
        raise ValueError("pairs of these vocabularies need more than 32 bits")
    tokens = _tokenised(docs, tokenizer, bytes_a, pattern, model, bytes_b)

    def aligned(row: dict) -> Iterator[Aligned]:
        numbers = (np.array(row[c], np.int64) for c in ("n_a", "n_b"))
        return portions(unsqueezed(row["a"], kind_a), unsqueezed(row["b"], kind_b), *numbers, size_a, size_b)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, docs = pack_pairs(aligned(row), width)
            of = bucket(keys.astype(np.int64), width)
            cuts = [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), keys.size]
            out = [
                (row["pack"], int(of[i]), _packed(keys[i:j]), squeezed(docs[i:j].astype(np.uint32)))
                for i, j in zip(cuts, cuts[1:])
            ]
            yield rows(PAIRS, out)

    found = materialise(tokens.mapInArrow(pairs, _ddl(PAIRS)), "pairs")
    n_packs = max(1, tokens.count())
    listed = _counted(found, n_packs, width).groupBy("pack").agg(F.collect_list(F.struct("keys", "counts", "best")).alias("known"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = _written(len(bytes_a), len(bytes_b))
        for row in _rows(batches):
            known = row["known"] or []
            keys = [_unpacked(k["keys"]) for k in known]
            counts = [unsqueezed(k["counts"], np.int64) for k in known]
            best = [np.unpackbits(unsqueezed(k["best"], np.uint8), count=n.size).astype(bool) for k, n in zip(known, keys)]
            held = [np.concatenate([np.zeros(0, t), *c]) for t, c in ((np.uint32, keys), (np.int64, counts), (bool, best))]
            order = np.argsort(held[0])
            held = [c[order] for c in held]
            at = 0
            for part in aligned(row):
                numbers = (c.tolist() for c in (part.n_a, part.n_b, part.n_groups, *part.sums(*held)))
                ids = row["ids"][at:at + part.n_a.size]
                yield rows(OUT, [*zip(ids, *numbers, part.texts(written), strict=True)])
                at += len(ids)

    return tokens.join(listed, "pack", "left").mapInArrow(again, _ddl(OUT))


def digests(aligned: DataFrame) -> DataFrame:
    """`aligned` with the digest of its groups, '' without tokens, in place of their text."""
    return aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
