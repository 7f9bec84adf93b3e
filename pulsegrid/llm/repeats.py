"""Removal of byte strings that an earlier document has, by a collection's Burrows-Wheeler transform.

The column-wise construction sorts short strings, so texts are cut first: every window of `WIDTH` bytes
names one of its grams (its content alone decides which), and consecutive windows that name the
same one make a piece. Equal windows lie in pieces of the same gram, so pieces are dealt to buckets
by it and each bucket is a collection of its own: the transform with common prefixes puts equal
windows beside each other, and the least id of such a run goes back to all its pieces.

Pieces whose gram a single document has cannot share a window; they are found beforehand from the
grams' hashes alone. Nor can a piece, however often it was copied, whose gram no unlike piece of its bucket
has: it stays out of the transform, as do windows at the borders of a piece, and whole pieces, whose hash no other
window of its bucket has. A gram met in very many unlike pieces is dealt by whole windows instead.
All of this leaves the result as it is. Documents travel in packs, requests and answers are one row a pack and bucket,
so a passage that every document holds is asked for once a pack. With the requests goes a list of the places
that asked, and comes back with the answers, so that a pack is cut without looking for its pieces again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.batches import small_batches, small_bytes
from pulsegrid.llm.packs import PACK_BYTES, gathered, rows, squeezed, unsqueezed
from pulsegrid.llm.transform import least_ids
from pulsegrid.session import materialise

#: Bytes of a window, of a gram, and of the shorter grams whose least hash picks one.
WIDTH, GRAM, SHORT = 50, 32, 13
#: Windows handled at a time.
BLOCK = 1 << 16
#: Pieces whose windows are hashed at a time.
STRINGS = 1 << 14
#: Bytes of text whose grams, and whose pieces, one bucket gets; buckets that any number of texts may have.
GRAM_BYTES, PIECE_BYTES, BUCKETS = 1 << 20, 16 << 20, 512
#: A gram with more unlike pieces, counted by pack, is dealt by whole windows.
HOT = 20_000
#: What a null id counts as: no document's id is larger.
LAST = np.iinfo(np.int64).max

PACKS = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("body", pa.binary()), ("bytes", pa.int64())])
GRAMS = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
CODES = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("codes", pa.binary())])
PIECES = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])
ASKED = PIECES.append(pa.field("places", pa.binary()))
LEAST = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("least", pa.binary())])
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(SPAN)), ("kept", pa.binary())])
OUT_DDL = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _joined(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of two neighbours `step` apart from hashes of each: a polynomial, cheap to extend."""
    out = h[:-step] * (_FIRST ^ np.uint64(step << 1)).astype(h.dtype)
    out += h[step:]
    return out


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs whose every bit counts."""
    z = left * _FIRST
    z += right
    z ^= z >> np.uint64(32)
    z *= _SECOND
    z ^= z >> np.uint64(29)
    return z


class Pieces:
    """The pieces of a pack: `start`, `windows` (their number), `gram` (hash), `doc`, `name` (hash of the content)."""

    def __init__(self, body: np.ndarray, sizes: np.ndarray):
        self.body, self.sizes = body, sizes
        self.ends = np.cumsum(sizes)
        parts = [self._block(at) for at in range(0, max(0, body.size - WIDTH + 1), BLOCK)]
        columns = zip(*parts, strict=True) if parts else ([np.zeros(0, np.int64)],) * 2 + ([np.zeros(0, np.uint64)],) * 2
        self.start, self.windows, self.gram, self.name = (np.concatenate(c) for c in columns)
        self.doc = np.searchsorted(self.ends, self.start, side="right")

    def _windows(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a block's windows: place of the gram, the eight bytes from any place of the block on, and which windows lie in one text."""
        data = self.body[at:at + BLOCK + WIDTH - 1]
        n = data.size - WIDTH + 1
        short = data.astype(np.uint32)
        short += np.uint32(1)
        for step in (1, 2, 4, SHORT - 8):
            short = _joined(short, step)
        short ^= short >> np.uint32(15)
        short *= np.uint32(_SECOND & np.uint64(0xFFFFFFFF))
        # leftmost least hash of the short grams of each window, doubling
        count, span = WIDTH - SHORT + 1, 1
        least = short.astype(np.uint64)
        least <<= np.uint64(32)
        least |= np.arange(short.size, dtype=np.uint64)
        while span < count:
            step = min(span, count - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        own = np.arange(n, dtype=np.int32)
        offset = least.astype(np.uint32).view(np.int32)
        offset -= own
        offset %= np.int32(WIDTH - GRAM + 1)
        place = own + offset
        eight = np.ndarray((data.size - 7,), np.uint64, data, strides=(1,))
        # windows that start in the last bytes of a text reach into the next
        edge = np.zeros(n + 1, np.int16)
        first, last = np.searchsorted(self.ends, (at, at + n + WIDTH), side="right")
        ends = self.ends[first:last + 1]
        for bounds, sign in ((np.maximum(ends - WIDTH + 1, ends - self.sizes[first:last + 1]), 1), (ends, -1)):
            edge += sign * np.bincount(np.clip(bounds - at, 0, n), minlength=n + 1).astype(np.int16)
        return place, eight, np.cumsum(edge[:-1], dtype=np.int16) == 0

    def _block(self, at: int) -> tuple[np.ndarray, ...]:
        place, eight, whole = self._windows(at)
        new = np.ones(place.size, bool)
        np.not_equal(place[1:], place[:-1], out=new[1:])
        new[1:] |= whole[1:] != whole[:-1]
        start = np.flatnonzero(new)
        n = np.diff(start, append=place.size)
        kept = whole[start]
        start, n = start[kept], n[kept]

        def gram(places: np.ndarray) -> np.ndarray:
            pairs = (_mixed(eight[places + i], eight[places + i + 8]) for i in (0, 16))
            return _mixed(*pairs)

        end = start + n + WIDTH - 1 - GRAM  # of the last gram inside the piece
        return start + at, n, gram(place[start]), _mixed(gram(start), gram(end) + n.astype(np.uint64))


class Requests:
    """What a pack asks for: its distinct pieces of shared grams, each in a bucket, and where they occur."""

    def __init__(self, pieces: Pieces, ids: np.ndarray, codes: np.ndarray, buckets: int):
        """`codes` of the pieces: 0 not shared, 1 shared, 2 shared and dealt by windows."""
        whole = codes == 1
        hot = np.flatnonzero(codes == 2)
        n = pieces.windows[hot]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.concatenate([pieces.start[whole], np.repeat(pieces.start[hot], n) + inside])
        size = np.concatenate([pieces.windows[whole], np.ones(inside.size, np.int64)]) + WIDTH - 1
        doc = np.concatenate([pieces.doc[whole], np.repeat(pieces.doc[hot], n)])
        body = pieces.body.tobytes()
        number: dict[bytes, int] = {}
        texts = [body[s:e] for s, e in zip(start.tolist(), (start + size).tolist(), strict=True)]
        self.number = np.array([number.setdefault(t, len(number)) for t in texts], np.int64)
        self.start, self.windows, self.id = start, size - WIDTH + 1, ids[doc]
        self.texts = [*number]
        self.least = np.full(len(number), LAST)
        np.minimum.at(self.least, self.number, self.id)
        self.bucket = np.zeros(len(number), np.int64)
        self.bucket[self.number[:whole.sum()]] = (pieces.gram[whole] % np.uint64(buckets)).astype(np.int64)
        if hot.size:
            h = np.array([hash_of(t) for t in texts[whole.sum():]], np.uint64)
            self.bucket[self.number[whole.sum():]] = (h % np.uint64(buckets)).astype(np.int64)

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, numbers of its pieces), ascending."""
        order = np.argsort(self.bucket, kind="stable")
        held = self.bucket[order]
        cuts = [*np.flatnonzero(np.diff(held, prepend=-1)).tolist(), held.size]
        for i, j in zip(cuts, cuts[1:]):
            yield int(held[i]), order[i:j]

    def places(self) -> bytes:
        """Where pieces start, their windows, and their place among the pieces by bucket: all that `_removed` needs."""
        rank = np.empty(len(self.texts), np.uint32)
        rank[np.argsort(self.bucket, kind="stable")] = np.arange(len(self.texts), dtype=np.uint32)
        columns = (np.diff(self.start.astype(np.uint32), prepend=np.uint32(0)), rank[self.number])
        # equal bytes of neighbours beside each other: most of them are zero
        planes = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 4).T.ravel() for c in columns]
        return squeezed(np.concatenate([*planes, self.windows.astype(np.uint8)]))


def _placed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, place by bucket, windows) of what `Requests.places` made."""
    flat = unsqueezed(data, np.uint8)
    n = flat.size // 9
    delta, rank = (np.ascontiguousarray(flat[i:i + 4 * n].reshape(4, n).T).view(np.uint32).ravel() for i in (0, 4 * n))
    return np.cumsum(delta, dtype=np.uint32).astype(np.int64), rank.astype(np.int64), flat[8 * n:].astype(np.int64)


def hash_of(window: bytes) -> int:
    """A hash of one window, the same everywhere."""
    h = np.frombuffer(window, np.uint8).astype(np.uint64) + np.uint64(1)
    while h.size > 1:
        if h.size % 2:
            h = np.append(h, np.uint64(0))
        h = _mixed(h[::2], h[1::2])
    return int(h[0])


class _Grams:
    """Hashes of a pack's grams, ascending by bucket, and which of them each piece has."""

    def __init__(self, pieces: Pieces, buckets: int):
        bucket = pieces.gram % np.uint64(buckets)
        keys = bucket << np.uint64(32) | pieces.gram >> np.uint64(32)
        self.keys, self.of = np.unique(keys, return_inverse=True)
        self.bucket = (self.keys >> np.uint64(32)).astype(np.int64)

    def counts(self, pieces: Pieces, ids: np.ndarray) -> np.ndarray:
        """1 if documents of several ids have it, and twice the number of unlike pieces (127 at most)."""
        low, high = np.full(self.keys.size, LAST), np.full(self.keys.size, -LAST)
        np.minimum.at(low, self.of, ids[pieces.doc])
        np.maximum.at(high, self.of, ids[pieces.doc])
        _, first = np.unique(_mixed(self.keys[self.of], pieces.name), return_index=True)
        unlike = np.bincount(self.of[first], minlength=self.keys.size)
        return (np.minimum(unlike, 127) * 2 + (low < high)).astype(np.uint8)


def _judged(group: pa.Table) -> pa.Table:
    """Codes of the grams of a bucket, for every pack."""
    packs = group.column("pack").to_pylist()
    hashes = [unsqueezed(h, np.uint32) for h in group.column("hashes").to_pylist()]
    counts = np.concatenate([unsqueezed(c, np.uint8) for c in group.column("counts").to_pylist()])
    _, of, met = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    several = (met > 1) | (np.bincount(of, weights=counts & 1) > 0)
    hot = np.bincount(of, weights=counts >> 1) > HOT
    codes = np.where(several, 1 + hot, 0).astype(np.uint8)[of]
    cuts = np.cumsum([h.size for h in hashes])[:-1]
    bucket = group.column("bucket")[0].as_py()
    out = [(p, bucket, squeezed(c)) for p, c in zip(packs, np.split(codes, cuts), strict=True) if c.any()]
    return pa.Table.from_batches([rows(CODES, out)])


def _partnered(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of unlike pieces (concatenated, and their lengths) have a gram that another one has too."""
    pieces = Pieces(data, sizes)
    # borders of blocks may cut a piece in two of the same gram
    gram = pieces.gram[np.searchsorted(pieces.doc, np.arange(sizes.size))]
    _, of, met = np.unique(gram, return_inverse=True, return_counts=True)
    return met[of] > 1


def _window_hashes(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of all windows of pieces (concatenated, and their lengths), in order."""
    out, ends = [np.zeros(0, np.uint64)], np.cumsum(sizes)
    for i in range(0, sizes.size, STRINGS):
        part = sizes[i:i + STRINGS]
        h = data[ends[i] - part[0]:ends[i + part.size - 1]].astype(np.uint64) + np.uint64(1)
        for step in (1, 2, 4, 8, 16):
            h = _joined(h, step)
        n = part - WIDTH + 1
        at = np.arange(n.sum()) + np.repeat(np.cumsum(part) - part - np.cumsum(n) + n, n)
        out.append(_mixed(h[at], h[at + WIDTH - 32]))
    return np.concatenate(out)


def _met_again(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first, behind the last) of the windows of unlike pieces that may lie in another one too.

    A window whose hash no other window has lies in its piece alone; windows between two that remain stay with them.
    """
    _, of, met = np.unique(_window_hashes(data, sizes), return_inverse=True, return_counts=True)
    again = np.append(0, np.cumsum(met[of] > 1))
    windows = sizes - WIDTH + 1
    ends = np.cumsum(windows)
    starts = ends - windows
    kept = np.flatnonzero(again[ends] > again[starts])
    # places of the first and the last such window of each piece
    first = np.searchsorted(again, again[starts[kept]], side="right") - 1
    last = np.searchsorted(again, again[ends[kept]], side="left")
    return kept, first - starts[kept], last - starts[kept]


def _inside(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of runs of n."""
    return np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)


def _matched(group: pa.Table) -> pa.Table:
    """Least ids of the windows of a bucket's pieces, for every pack."""
    asked = []
    number: dict[bytes, int] = {}
    for row in group.to_batches():
        for r in row.to_pylist():
            sizes = unsqueezed(r["sizes"], np.uint8).astype(np.int64)
            body, ends = unsqueezed(r["body"], np.uint8).tobytes(), np.cumsum(sizes).tolist()
            texts = (body[i:j] for i, j in zip([0, *ends], ends))
            asked.append((r["pack"], np.array([number.setdefault(t, len(number)) for t in texts]), unsqueezed(r["ids"], np.int64)))
    ids = np.full(len(number), LAST)
    for _, numbers, own in asked:
        np.minimum.at(ids, numbers, own)
    sizes = np.array([len(t) for t in number])
    data = np.frombuffer(b"".join(number), np.uint8)
    windows = sizes - WIDTH + 1
    starts = np.cumsum(windows) - windows
    # a window of a piece without partners lies in that piece alone
    some, least = np.flatnonzero(_partnered(data, sizes)), np.repeat(ids, windows)
    begins = np.cumsum(sizes) - sizes
    if some.size:
        kept, first, last = _met_again(data[_inside(begins[some], sizes[some])], sizes[some])
        some, n = some[kept], last - first
    if some.size:
        texts = data[_inside(begins[some] + first, n + WIDTH - 1)]
        least[_inside(starts[some] + first, n)] = least_ids(texts, n + WIDTH - 1, ids[some], WIDTH)
    bucket = group.column("bucket")[0].as_py()
    out = []
    for pack, numbers, _ in asked:
        out.append((pack, bucket, squeezed(least[_inside(starts[numbers], windows[numbers])])))
    return pa.Table.from_batches([rows(LEAST, out)])


def _answered(group: pa.Table) -> pa.Table:
    """The answers of `_matched`, a row a row, with the places that came with the questions."""
    return _matched(group).append_column("places", group.column("places"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: they are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ids(row: dict) -> np.ndarray:
    return np.array([LAST if i is None else i for i in row["ids"]], np.int64)


def _opened(row: dict) -> tuple[Pieces, np.ndarray]:
    return Pieces(unsqueezed(row["body"], np.uint8), np.array(row["sizes"], np.int64)), _ids(row)


def _requests(row: dict, gram_buckets: int, piece_buckets: int) -> Requests:
    pieces, ids = _opened(row)
    grams = _Grams(pieces, gram_buckets)
    codes = np.zeros(grams.keys.size, np.uint8)
    for answer in row["judged"] or []:
        first, last = np.searchsorted(grams.bucket, (answer["bucket"], answer["bucket"] + 1))
        codes[first:last] = unsqueezed(answer["codes"], np.uint8)
    return Requests(pieces, ids, codes[grams.of], piece_buckets)


def _removed(ids: np.ndarray, sizes: np.ndarray, answers: list[dict]) -> np.ndarray:
    """Which bytes of a pack's texts are covered by windows that a smaller id has too."""
    start, rank, windows = _placed(next(a["places"] for a in answers if a["places"]))
    least = np.concatenate([unsqueezed(a["least"], np.int64) for a in sorted(answers, key=lambda a: a["bucket"])])
    ends = np.cumsum(sizes)
    own = ids[np.searchsorted(ends, start, side="right")]
    of_rank = np.zeros(int(rank.max()) + 1, np.int64)
    of_rank[rank] = windows
    starts = (np.cumsum(of_rank) - of_rank)[rank]
    edge = np.zeros(int(ends[-1]) + 1, np.int8)
    step = 1 << 16
    for i in range(0, start.size, step):
        part = slice(i, i + step)
        n = windows[part]
        taken = least[_inside(starts[part], n)] < np.repeat(own[part], n)
        place = _inside(start[part], n)[taken]
        # no place starts two windows: a byte is covered by WIDTH at most
        edge[place] += 1
        edge[place + WIDTH] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8) > 0


def without_repeats(docs: DataFrame) -> DataFrame:
    """A row per row of `docs`: doc_id, n_bytes, the removed spans (bytes, end exclusive) and the bytes kept.

    Removed is what strings of WIDTH bytes cover that also start in a document with a smaller doc_id. A
    null text is empty. A null id is larger than every other and equal to another null; rows with equal ids
    don't remove each other's text. Other columns are ignored. Files of the transform are the task's own
    and gone with it; all that later stages read lies in the shared folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    small_bytes(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in gathered(batches, PACK_BYTES):
            sizes = [len(t) for t in texts]
            yield rows(PACKS, [(ids, sizes, squeezed(np.frombuffer(b"".join(texts), np.uint8)), sum(sizes))])

    source = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    packs = source.mapInArrow(pack, "ids array<bigint>, sizes array<bigint>, body binary, bytes bigint")
    packs = materialise(packs.withColumn("pack", F.monotonically_increasing_id()), "packs")
    total = packs.agg(F.sum("bytes")).first()[0] or 0
    gram_buckets = max(1, min(total // GRAM_BYTES, max(BUCKETS, total // (64 * GRAM_BYTES))))
    piece_buckets = max(1, total // PIECE_BYTES)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pieces, ids = _opened(row)
            found = _Grams(pieces, gram_buckets)
            counts = found.counts(pieces, ids)
            hashes = (found.keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cuts = [*np.flatnonzero(np.diff(found.bucket, prepend=-1)).tolist(), found.bucket.size]
            yield rows(GRAMS, [(row["pack"], int(found.bucket[i]), squeezed(hashes[i:j]), squeezed(counts[i:j])) for i, j in zip(cuts, cuts[1:])])

    asked = packs.mapInArrow(grams, "pack bigint, bucket int, hashes binary, counts binary")
    judged = asked.groupBy("bucket").applyInArrow(_judged, "pack bigint, bucket int, codes binary")
    judged = materialise(judged.groupBy("pack").agg(F.collect_list(F.struct("bucket", "codes")).alias("judged")), "judged")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            wanted = _requests(row, gram_buckets, piece_buckets)
            out, held = [], [*wanted.by_bucket()]
            # the places go with one of the questions, of another bucket for every pack
            carrier = held[(row["pack"] * 2654435761 >> 16) % len(held)][0] if held else None
            for bucket, numbers in held:
                texts = [wanted.texts[i] for i in numbers.tolist()]
                sizes = np.array([len(t) for t in texts], np.uint8)
                body = np.frombuffer(b"".join(texts), np.uint8)
                places = wanted.places() if bucket == carrier else None
                out.append((row["pack"], bucket, squeezed(body), squeezed(sizes), squeezed(wanted.least[numbers]), places))
            yield rows(ASKED, out)

    questions = "pack bigint, bucket int, body binary, sizes binary, ids binary, places binary"
    asked = packs.join(judged, "pack").mapInArrow(pieces, questions)
    matched = asked.groupBy("bucket").applyInArrow(_answered, "pack bigint, bucket int, least binary, places binary")
    matched = matched.groupBy("pack").agg(F.collect_list(F.struct("bucket", "least", "places")).alias("matched"))
    answers = materialise(matched, "answers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            body = unsqueezed(row["body"], np.uint8)
            if row["matched"]:
                gone = _removed(_ids(row), np.array(row["sizes"], np.int64), row["matched"])
            else:
                gone = np.zeros(body.size, bool)
            out, at = [], 0
            for doc_id, size in zip(row["ids"], row["sizes"], strict=True):
                mine, text = gone[at:at + size], body[at:at + size]
                turns = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                spans = [{"start": i, "end": j} for i, j in zip(turns[::2], turns[1::2], strict=True)]
                out.append((doc_id, size, spans, text[~mine].tobytes()))
                at += size
            yield rows(OUT, out)

    return packs.join(answers, "pack", "left").mapInArrow(cut, OUT_DDL)


def removal_report(found: DataFrame) -> DataFrame:
    """Numbers of removed bytes and spans, and the digest of the bytes kept."""
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
