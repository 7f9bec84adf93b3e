"""Byte-pair encoding by a trie of words.

The encoding of a word is fixed by the encodings of its prefixes: the last token of a prefix is the
one token that ends it and stands its ground beside the last token of what is left. So the
distinct words of a batch go into a trie, and a depth-first walk gives each node the last token of its
prefix; prefixes that words share are encoded once. Reading the last tokens backwards spells a
word's encoding.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches

#: Words whose encodings a task keeps: this many lately used, and as many before, some 200 bytes each.
#: Longer ones than KEPT_LETTERS are not kept. Results depend on neither. Python workers outlive tasks
#: and operators, so nothing stays beyond a task.
KEPT, KEPT_LETTERS = 150_000, 64
#: Runs of text whose words go into one trie.
TRIE_RUNS = 20_000
#: Bytes of text encoded together.
CHUNK = 1 << 22
#: Marks that are one word behind letters.
MARKS = ".,;:!?"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Tokenizer:
    """A word-end BPE tokenizer read from the text of its JSON file."""

    def __init__(self, text: str, kept: int | None = None):
        self.kept = kept or KEPT
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("not a lower-casing word-end BPE tokenizer without decoder")
        self.end = model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        found = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile(f"({'|'.join(found)})") if found else None
        self.letters = str.maketrans(dict(enumerate(_byte_letters())))
        #: per token: whether it stands its ground after a left neighbour ('': at a word's start)
        self.after: dict[str, dict[str, bool]] = {t: {} for t in self.vocab}
        self.pairs = 0
        self.parts: dict[str, tuple[int, str, str] | None] = {}
        plain = {t.removesuffix(self.end) for t in self.vocab}
        #: beginnings of tokens, and the tokens that end like them, the longest first
        self.begins = {t[:n] for t in plain for n in range(len(t) + 1)}
        self.options: dict[str, list[tuple[str, int, dict[str, bool]]]] = {}
        self.known, self.known_before = {}, {}

    def _part(self, token: str) -> tuple[int, str, str] | None:
        """Rank and parts of the merge that completes a token; rank -1 for a letter, None if none does."""
        if token in self.parts:
            return self.parts[token]
        plain = token.removesuffix(self.end)
        symbols = [*plain[:-1], plain[-1] + self.end] if plain != token else list(token)
        found = (-1, token, token)
        while len(symbols) > 1:
            ranks = [self.ranks.get(p, len(self.ranks)) for p in zip(symbols, symbols[1:], strict=False)]
            least = min(ranks)
            if least == len(self.ranks):
                found = None
                break
            at = ranks.index(least)
            found = (least, symbols[at], symbols[at + 1])
            symbols[at:at + 2] = ["".join(found[1:])]
        self.parts[token] = found
        return found

    def _fits(self, left: str, right: str) -> bool:
        """Whether the two tokens come out as they are from the letters of both ('' on the left: nothing).

        Merges are undone from the last to the first; at every step the symbols that meet at the
        border must not have had an earlier merge of their own. Of equal ranks the leftmost is first.
        """
        if self.pairs > 2 * self.kept:
            self.pairs = 0
            for known in self.after.values():
                known.clear()
        x, y = (self._part(left) if left else (-1, "", "")), self._part(right)
        fits = x is not None and y is not None
        a, b, limit = left, right, len(self.ranks)
        while fits and left:
            rank = self.ranks.get((a, b), limit)
            if rank < limit:
                fits = False
            elif x[0] > y[0]:
                a, limit = x[2], x[0]
                x = self._part(a)
            elif y[0] >= 0:
                b, limit = y[1], y[0] + 1
                y = self._part(b)
            else:
                break
        self.after[right][left] = fits
        self.pairs += 1
        return fits

    def _options(self, tail: str, close: str) -> list[tuple[str, int, dict[str, bool]]]:
        """Tokens that end like `tail`, the longest first: with their letters, and what they stand after."""
        sizes = range(len(tail), 0, -1)
        found = [(t, n, self.after[t]) for n in sizes if (t := tail[len(tail) - n:] + close) in self.after]
        self.options[tail + close] = found
        return found

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Encodings of distinct words, from a trie of their letters."""
        root: dict = {}
        for word in words:
            letters = word.encode().decode("latin-1").translate(self.letters)
            node = root
            for letter in letters[:-1]:
                node = node.setdefault(letter, {})
            # a word's last letter is another symbol than the same letter inside: a leaf
            node[letters[-1] + self.end] = word
        out: dict[str, bytes] = {}
        # Depth first. path has the last tokens of the prefixes on the way, '' for the empty one; tail is
        # as much of a prefix's end as tokens begin with, so it has all tokens that end the prefix.
        path = [""]
        todo = [(root, "", 0, edge) for edge in root]
        begins, options, end = self.begins, self.options, self.end
        while todo:
            node, tail, depth, edge = todo.pop()
            del path[depth + 1:]
            below = node[edge]
            leaf = type(below) is str
            tail += edge[0]
            while tail not in begins:
                tail = tail[1:]
            key = tail + end if leaf else tail
            depth += 1
            for token, size, after in options.get(key) or self._options(tail, end if leaf else ""):
                left = path[depth - size]
                fits = after.get(left)
                if fits or fits is None and self._fits(left, token):
                    break
            else:
                raise ValueError(f"no token ends {tail!r}")
            if leaf:
                out[below] = self._spelled(token, depth, path)
            else:
                path.append(token)
                for e in below:
                    todo.append((below, tail, depth, e))
        return out

    def _spelled(self, last: str, length: int, path: list[str]) -> bytes:
        ids = [self.vocab[last]]
        at = length - len(last) + len(self.end)
        while at:
            last = path[at]
            ids.append(self.vocab[last])
            at -= len(last)
        ids.reverse()
        return pack(f"<{len(ids)}I", *ids)

    def _split(self, run: str) -> list:
        """Words and, as integers, special tokens of a text."""
        if not self.specials or "<" not in run or not (parts := self.specials.split(run))[1:]:
            return self._plain(run)
        out: list = []
        for i, part in enumerate(parts):
            out += [self.special[part]] if i % 2 else self._plain(part)
        return out

    def _plain(self, run: str) -> list[str]:
        if not run.isascii():
            # letter by letter: no other form of sigma at the end of a word
            run = unicodedata.normalize("NFC", run).replace("Σ", "σ")
        run = run.lower()
        if run.isalpha():
            return [run]
        if run[-1:] in MARKS and run[:-1].isalpha():
            return [run[:-1], run[-1]]
        return self.words.findall(run)

    def _encoded(self, runs: list[str]) -> list[bytes]:
        """Ids of some runs of text."""
        if len(self.known) > self.kept:
            self.known, self.known_before = {}, self.known
        known, before = self.known, self.known_before
        words = [self._split(r) for r in runs]
        asked = {w for parts in words for w in parts if w not in known}
        known |= {w: ids for w in asked if (ids := before.get(w)) is not None}
        learned: dict = {i: pack("<I", i) for i in self.special.values()}
        learned |= self.learn([w for w in asked if type(w) is str and w not in known])
        known |= {w: ids for w, ids in learned.items() if type(w) is str and len(w) <= KEPT_LETTERS}
        gc.freeze()  # what is kept needs no walk in search of cycles
        return [b"".join([known[w] if w in known else learned[w] for w in parts]) for parts in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's end.

        Blanks and line breaks never are part of a word: the runs between them are numbered, and only
        distinct ones encoded.
        """
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        runs = split.flatten().dictionary_encode()
        distinct = runs.dictionary
        encoded: list[bytes] = []
        for at in range(0, len(distinct), TRIE_RUNS):
            encoded += self._encoded(distinct.slice(at, TRIE_RUNS).to_pylist())
        ids = np.frombuffer(b"".join(encoded), "<u4")
        sizes = np.array([len(e) // 4 for e in encoded], np.int64)
        place = np.cumsum(sizes) - sizes
        number = runs.indices.to_numpy()
        size = sizes[number]
        ends = np.cumsum(size)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(place[number] - (ends - size), size)
        borders = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        return ids[places], np.append(0, ends)[borders]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens with blanks between them, special ones too."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])


def _chunks(batches: Iterator[pa.Array], least: int | None = None) -> Iterator[pa.Array]:
    """The texts of all batches, `least` (CHUNK) bytes or more together."""
    least = least or CHUNK
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch)).as_py() or 0
        if size >= least:
            yield pa.concat_arrays(held)
            held, size = [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield pa.concat_arrays(held)


def _vocabulary(spark: SparkSession, path: str):
    """The tokenizer's file, read by the driver and sent to every executor: 1.7 MB, whatever the data."""
    small_batches(spark)
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(spark: SparkSession, text: Column, path: str) -> Column:
    """Token ids (array of int) of a text column, as the tokenizer at `path` gives them.

    No special tokens are added; those spelled out in a text are found. Null and empty texts
    have no ids.
    """
    vocabulary = _vocabulary(spark, path)

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = Tokenizer(vocabulary.value)
        for texts in _chunks(batches):
            found, ends = tokenizer.encode(texts)
            yield pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(found.view(np.int32)))

    return ids(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """Text of token ids: the tokens with blanks between them, special ones too; null for null."""
    vocabulary = _vocabulary(spark, path)

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = Tokenizer(vocabulary.value)
        for batch in batches:
            rows = (None if r.as_py() is None else r.values.to_numpy(zero_copy_only=False) for r in batch)
            yield pa.array([None if r is None else tokenizer.decode(r) for r in rows], pa.string())

    return text(ids)


def round_trip(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    keep: tuple[str, ...] = (),
    chunk: int | None = None,
    kept: int | None = None,
) -> DataFrame:
    """`doc_id`, `n_tokens` and hex SHA-256 of the ids (little-endian unsigned 32-bit integers) and of
    the decoded text, for every row; `ids` and `decoded` themselves too, if `keep` names them.

    Texts are encoded and decoded in one pass of one Python worker. `chunk` bytes of text go into one
    step, and a task keeps the encodings of `kept` words: less memory for more time. Null and empty texts have no
    tokens and decode to the empty text; null and repeated ids keep their rows; other columns are
    ignored.
    """
    vocabulary = _vocabulary(spark, path)
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    kinds |= {"ids": pa.list_(pa.int32())} if "ids" in keep else {}
    kinds |= {"decoded": pa.string()} if "decoded" in keep else {}
    names = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}

    def described(ids: np.ndarray, text: str) -> list:
        row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]
        return row + ([ids.view(np.int32)] if "ids" in keep else []) + ([text] if "decoded" in keep else [])

    @arrow_udf("struct<" + ", ".join(f"{c}: {names[k]}" for c, k in kinds.items()) + ">")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = Tokenizer(vocabulary.value, kept)
        for texts in _chunks(batches, chunk):
            ids, ends = tokenizer.encode(texts)
            rows = [described(own, tokenizer.decode(own)) for own in np.split(ids, ends[:-1])] if len(ends) else []
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], [*kinds])

    return docs.select("doc_id", found("text").alias("found")).select("doc_id", "found.*")
