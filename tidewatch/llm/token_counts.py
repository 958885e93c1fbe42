"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton enumerates all vocabulary pieces in a word, by end and from the longest; a
dynamic program carries the best score and the number of pieces to each character. Ties are the
tokenizer's: a path is replaced only by a strictly better one, so of equal ones the one whose last
piece begins first stays; a character without a piece of its own may be unknown, at ten below the
lowest score, and counts its UTF-8 bytes where the vocabulary has them all, else one for each
unbroken run. Words are split as the tokenizer does: blanks become the sign U+2581, which begins a
word, and one is put before the text. Pieces do not cross words, so a word's count is looked up once
it is known; the table of known words is bounded.

The vocabulary is a model file of a public tokenizer, whose pieces and scores are read as a unigram
model. Rows: null and empty texts have no tokens; every row is a document of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGN = "▁"
PENALTY = 10.0
#: Words whose counts a task remembers, and the longest of them.
KNOWN = 400_000
LONGEST = 64

Vocabulary = list[tuple[str, float]]


def vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


class Counter(dict):
    """Count of pieces by word; a word that is missing is worked out."""

    def __init__(self, pieces: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - PENALTY
        names = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))

    def __missing__(self, word: str) -> int:
        count = self.pieces(word)
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = count
        return count

    def pieces(self, word: str) -> int:
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        count, strange = [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        done = 0

        def close(end: int, single: bool) -> None:
            """The unknown character before ``end``, if it has no piece of its own."""
            if single or best[end - 1] is None:
                return
            value = best[end - 1] + self.unknown
            if best[end] is None or value > best[end]:
                best[end] = value
                if self.bytes:
                    count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count[end] = count[end - 1] + (not strange[end - 1])
                strange[end] = True

        single = False
        for last, (length, score) in self.automaton.iter(word):
            while done < last:
                close(done + 1, single)
                done, single = done + 1, False
            end, start = last + 1, last + 1 - length
            if best[start] is not None and (best[end] is None or best[start] + score > best[end]):
                best[end], count[end], strange[end] = best[start] + score, count[start] + 1, False
            single |= length == 1
        while done < n:
            close(done + 1, single)
            done, single = done + 1, False
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(SIGN, " ").split(" ")
        if not words[0] and len(words) > 1:
            del words[0]
        return sum(self[SIGN + w] for w in words)


def count_tokens(docs: DataFrame, pieces: Vocabulary) -> DataFrame:
    """``doc_id, source, n_tokens`` of all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces)
        for batch in batches:
            counts = [counter.text(t.as_py()) for t in batch["text"]]
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "source": batch["source"], "n_tokens": pa.array(counts, pa.int64())}
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(work, "doc_id bigint, source string, n_tokens bigint")
