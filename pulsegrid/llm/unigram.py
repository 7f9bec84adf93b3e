"""Token counts of a unigram tokenizer, without the tokens.

An Aho-Corasick automaton of the vocabulary lists the pieces that end at each place of a word;
dynamic programming carries the best score and its number of pieces, nothing else. Ties fall
as in the tokenizer: of equal scores the piece that starts first wins, scores are
doubles added from the left, and a character without a piece costs ten more than the worst
piece and counts as its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections import Counter as Tally
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udf

from pulsegrid.llm.batches import small_batches

SPACE = "▁"
PENALTY = 10.0
#: Words whose counts a task keeps, and the longest of them. Results depend on neither.
KEPT, KEPT_LETTERS = 400_000, 64


RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Counter:
    """Counts for a vocabulary of (piece, score); blanks are written as SPACE."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.letters = {c for p, _ in vocabulary for c in p}
        self.unknown = min(s for _, s in vocabulary) - PENALTY
        # no piece goes from a word on to the next, but for pieces of blanks
        self.words = all(SPACE not in p[1:] or set(p) == {SPACE} for p, _ in vocabulary)
        self.known: dict[str, complex] = {}

    def _best(self, text: str) -> complex:
        """Best score (real part) and its pieces (imaginary part) of a text."""
        scores, counts = [0.0], [0]
        found = list(self.pieces.iter(text))
        found.append((len(text), None))
        at = 0
        unknown, single = self.unknown, self.single
        for end, letter in enumerate(text):
            best, count = None, 0
            # pieces that end here, the longest first
            while found[at][0] == end:
                length, score = found[at][1]
                total = scores[end + 1 - length] + score
                if best is None or total > best:
                    best, count = total, counts[end + 1 - length] + 1
                at += 1
            if letter not in single:
                total = scores[end] + unknown
                if best is None or total > best:
                    best, count = total, counts[end] + len(letter.encode())
            scores.append(best)
            counts.append(count)
        return complex(scores[-1], counts[-1])

    def count(self, text: str) -> tuple[int, float]:
        """Pieces of a text and their score. The text gets a blank in front, if it has any character."""
        if not text:
            return 0, 0.0
        if not self.words:
            whole = self._best(SPACE + text.replace(" ", SPACE))
            return round(whole.imag), whole.real
        # pieces don't cross the start of a word with the blanks before it, nor a line break if none has one
        breaks = 0
        if "  " in text or text[0] == " " or SPACE in text or "\n" in self.letters:
            whole = SPACE + text.replace(" ", SPACE)
            lines = [whole] if "\n" in self.letters else whole.split("\n")
            breaks = len(lines) - 1
            words = [w for line in lines for w in RUNS.findall(line)]
        else:
            first, *lines = text.split("\n")
            breaks = len(lines)
            words = [SPACE + w for w in first.split(" ")]
            for line in lines:
                first, *rest = line.split(" ")
                words.append(first)
                words += [SPACE + w for w in rest]
        known = self.known
        if len(known) > KEPT:
            known.clear()
        long: dict[str, complex] = {}
        for word in {*words}.difference(known):
            (known if len(word) <= KEPT_LETTERS else long)[word] = self._best(word) if word else 0j
        start = complex(breaks * self.unknown, breaks)
        if long:
            whole = sum((known[w] for w in words if w not in long), start)
            # equal long words are counted first
            times = Tally(w for w in words if w in long)
            whole += sum((long[w] * n for w, n in times.items()), 0j)
        else:
            whole = sum(map(known.__getitem__, words), start)
        return round(whole.imag), whole.real


def vocabulary(model: bytes) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, without control, byte and unknown pieces."""
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = [i for i in range(pieces.get_piece_size()) if not (pieces.is_control(i) or pieces.is_byte(i) or pieces.is_unknown(i))]
    return [(pieces.id_to_piece(i), pieces.get_score(i)) for i in out]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_tokens` and `score` of every row of `docs`, by the pieces of the sentencepiece model at `path`.

    A null or empty text has no tokens and score 0; null and repeated ids keep their rows; other
    columns are ignored. The model, half a megabyte, is read by the driver and broadcast.
    """
    small_batches(docs.sparkSession)
    with open(path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    @arrow_udf("struct<n_tokens: long, score: double>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(vocabulary(model.value))
        for batch in batches:
            found = [counter.count(t.as_py() or "") for t in batch]
            parts = zip(*found, strict=True) if found else ((), ())
            arrays = [pa.array(p, k) for p, k in zip(parts, (pa.int64(), pa.float64()), strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["n_tokens", "score"])

    return docs.select("doc_id", counts("text").alias("found")).select("doc_id", "found.*")
