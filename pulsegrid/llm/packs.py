"""Runs of documents that a task handles as one, and arrays as bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes of text in a pack, roughly; a longer text is a pack of its own.
PACK_BYTES = 2 << 20


def gathered(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(ids, texts) of consecutive rows of `doc_id`, `text` (binary, never null), about `limit` bytes each."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if texts and held + len(text) > limit:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
    if texts:
        yield ids, texts


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unsqueezed(data: bytes, kind: np.dtype | type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def rows(schema: pa.Schema, values: list[tuple]) -> pa.RecordBatch:
    """A batch of `schema` of a list of rows."""
    columns = zip(*values, strict=True) if values else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
