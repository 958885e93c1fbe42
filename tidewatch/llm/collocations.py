"""Phrases whose words keep company more often than chance, by language.

Text is lower-cased in A-Z, split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at
blanks and tabs. A phrase is a run of words of one piece. Every run of one to ``longest`` words is
counted, in two passes over documents that stay where they were dealt:

1. Each part counts its own runs by hash and sends them to the hash partition that owns them. The
   partition merges what it gets into one Misra-Gries summary. Its capacity exceeds the
   partition's mass divided by the threshold (`ROOM` times over), so what the summary takes off any count, in all, is
   below the threshold: whatever reaches it is still there, and a run whose count and loss
   together stay below it is surely too rare. The answer to a part is those of its hashes that survive. A
   count that a part sends stops at the threshold, as it then proves itself; a run that is everywhere adds
   no more to the mass than that for each part.
2. Parts count the surviving runs as text, and their sums are exact. Hashes that collide can only
   let a run survive that the exact count then drops.

Both parts of a frequent phrase are at least as frequent, so all counts that a score needs are there.

Rows: null and empty texts have no words; a null language is ``und``; every row counts, repeated or not, and
ids are not read. Equal scores and counts are ordered by the phrase's UTF-8 bytes. An empty table has no
phrases. Memory: a part's run hashes (about 80 bytes for a word), the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.arrays import FOLDED, TWO, Rolling, Slice, Words, mix, slices, word_hashes, words
from tidewatch.llm.parts import SENT, ask, blocks_for, column, deal, distinct, each_part, pack, part_of, text_bytes, unpack
from tidewatch.staging import stage

NO_LANGUAGE = "und"
#: Bits of a hash beyond those that name its partition.
KEY_BITS = 40
#: Bytes of text to each run that a part sends, about; only the number of partitions depends on it.
_BYTES_A_RUN = 5
#: Texts are taken in slices of about so many bytes; a part's runs are merged when there are so many.
SLICE, MERGE = 1 << 20, 1 << 20
#: Counters of a summary for each threshold's worth of mass. One would do; with more, fewer rare runs survive.
ROOM = 4
#: Shares in which a language's best phrases are chosen before they meet.
_SHARES = 64
_U = np.uint64

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = _BREAK.copy()
_BLANK[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNTED = "lang string, n_words int, phrase string, n bigint"


class Runs:
    """The runs of words of a slice, piece by piece, and a 64-bit hash of each run and its language."""

    def __init__(self, part: Slice, salts: np.ndarray):
        self.part = part
        self.words: Words = words(part, _BLANK)
        self.hashes = word_hashes(part, self.words, FOLDED)
        marks = _BREAK[part.data].astype(np.int32)
        begin = part.offsets[:-1]
        np.add.at(marks, begin[begin < len(marks)], 1)
        self.piece = np.cumsum(marks, dtype=np.int32)[self.words.start]
        self.rolling = Rolling(self.hashes)
        self.salts = salts[self.words.documents()]

    def starts(self, length: int) -> np.ndarray:
        last = len(self.piece) - length + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[length - 1 :])

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return mix(self.rolling.of(start, start + length) ^ self.salts[start])


def _salts(languages: list[str]) -> np.ndarray:
    """A 64-bit value for the language of each document."""
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(languages)}
    return np.array([known[x] for x in languages], _U)


def _all_runs(docs: pa.Table) -> Iterator[Runs]:
    salts = _salts(column(docs, "lang").to_pylist())
    for part in slices(column(docs, "text"), SLICE):
        yield Runs(part, salts[part.first : part.first + len(part)])


def _count_type(least: int) -> type:
    return np.min_scalar_type(least).type


def _send(docs: pa.Table, longest: int, least: int, blocks: int) -> pa.Table:
    """A part's distinct hashes, as many leading bits as the partitions and `KEY_BITS` need, and counts."""
    found = [np.zeros(0, _U)]
    for runs in _all_runs(docs):
        for length in range(1, longest + 1):
            found.append(runs.of(runs.starts(length), length) >> _U(64 - _bits(blocks)))
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    return pack(
        part_of(docs), (keys >> _U(KEY_BITS)).astype(np.int64), blocks,
        keys.astype(np.uint32), (keys >> _U(32)).astype(np.uint8),
        np.minimum(counts, least).astype(_count_type(least)),
    )


def _bits(blocks: int) -> int:
    return KEY_BITS + int(np.log2(blocks))


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters, to find keys that reach ``least``. ``lost`` is
    what was taken off any one count; ``lost * (capacity + 1)`` never exceeds the mass taken in. A counter
    stops at ``least``: its key is proved, and what is taken off later stands in ``lost``."""

    def __init__(self, capacity: int, least: int):
        if least >= 1 << (64 - KEY_BITS):
            raise ValueError("the threshold is too high")
        self.capacity, self.least, self.lost = capacity, least, 0
        self.keys, self.counts = np.zeros(0, _U), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in counts or the counters of another summary of this capacity."""
        shift = _U(64 - KEY_BITS)
        both = np.concatenate((self.keys << shift | self.counts.astype(_U), keys << shift | counts.astype(_U)))
        both.sort()
        keys, counts = both >> shift, (both & _U((1 << (64 - KEY_BITS)) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        if len(first):
            keys, counts = keys[first], np.minimum(np.add.reduceat(counts, first), self.least)
        if len(keys) > self.capacity:
            place = len(counts) - self.capacity - 1
            cut = int(np.partition(counts, place)[place])
            counts = counts - cut
            self.lost += cut
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        """All keys that may have reached ``least``, ascending."""
        return self.keys[self.counts + self.lost >= self.least]


class _Marks:
    """Which keys are in a set. ``maybe`` is quick and true of a few others, by the low bits of the key."""

    def __init__(self, keys: np.ndarray, bits: int):
        self.keys = np.sort(keys)
        self.mask = _U((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[keys & self.mask] = True

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        return self.table[keys & self.mask]

    def among(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def _judge(got: pa.Table, least: int) -> pa.Table:
    """Merge what the parts sent to a partition, and return to each which of its runs survive."""
    sent = []
    for raw in got["sent"].to_pylist():
        low, high, counts = unpack(raw, np.uint32, np.uint8, _count_type(least))
        sent.append((low.astype(_U) | (high.astype(_U) << _U(32)), counts))
    mass = sum(int(counts.sum(dtype=np.int64)) for _, counts in sent)
    summary = Summary(ROOM * mass // least + 1, least)
    waiting, size = [], 0
    for i, (keys, counts) in enumerate(sent):
        waiting.append((keys, counts))
        size += len(keys)
        if size > summary.capacity or i == len(sent) - 1:
            summary.merge(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting, size = [], 0
    stay = _Marks(summary.survivors(), 22)
    answers = []
    for keys, _ in sent:
        keys = keys[stay.maybe(keys)]
        keys = keys[stay.among(keys)]
        answers.append(keys.astype(np.uint32).tobytes() + (keys >> _U(32)).astype(np.uint8).tobytes())
    return pa.table(
        {
            "part": column(got, "part"), "kind": pa.array(["run"] * len(sent), pa.string()),
            "block": column(got, "block"), "bits": pa.array(answers, pa.binary()),
        }
    )


def _texts(runs: Runs, start: np.ndarray, length: int) -> pa.Array:
    """The runs' words in lower case, one blank between them."""
    data, begin, end = runs.part.data, runs.words.start[start], runs.words.end[start + length - 1]
    size = end - begin
    offsets = np.concatenate(([0], np.cumsum(size)))
    step = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    chars = data[np.repeat(begin, size) + step]
    made = pa.Array.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[chars])]
    ).cast(pa.binary())
    if length == 1:
        return made
    blanks, tabs = (np.add.reduceat(chars == c, offsets[:-1], dtype=np.int64) if len(size) else size for c in (32, 9))
    wider = np.flatnonzero((blanks != length - 1) | (tabs > 0))
    if not len(wider):
        return made
    texts = made.to_pylist()
    for i in wider.tolist():
        texts[i] = b" ".join(texts[i].split())
    return pa.array(texts, pa.binary())


def _merged(found: list[tuple]) -> tuple:
    """Runs of several slices, each once, with their counts summed."""
    one, two, often, length, lang = (np.concatenate([f[i] for f in found]) for i in range(5))
    order, new = distinct(one, two)
    begin = np.flatnonzero(new)
    kept = order[begin]
    sums = np.add.reduceat(often[order], begin) if len(begin) else often
    texts = pa.concat_arrays([f[5] for f in found]).take(pa.array(kept))
    return one[kept], two[kept], sums, length[kept], lang[kept], texts


def _count(docs: pa.Table, answers: pa.Table, longest: int, blocks: int) -> pa.Table:
    """Counts of a part's surviving runs as text, and of all its words (``n_words`` 0) by language."""
    keys = [np.zeros(0, _U)]
    for block, raw in zip(answers["block"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        low, high = unpack(raw, np.uint32, np.uint8)
        keys.append(low.astype(_U) | (high.astype(_U) << _U(32)) | _U(block << KEY_BITS))
    stay = _Marks(np.concatenate(keys), 24)
    languages = column(docs, "lang").dictionary_encode()
    code = languages.indices.to_numpy()
    n_words = np.zeros(len(languages.dictionary), np.int64)
    found: list[tuple] = []
    waiting = 0
    for runs in _all_runs(docs):
        own = code[runs.part.first : runs.part.first + len(runs.part)]
        np.add.at(n_words, own, runs.words.counts())
        own = own[runs.words.documents()]
        other = Rolling(mix(runs.hashes), TWO)
        for length in range(1, longest + 1):
            start = runs.starts(length)
            one = runs.of(start, length)
            mine = stay.maybe(one >> _U(64 - _bits(blocks)))
            start, one = start[mine], one[mine]
            two = other.of(start, start + length) ^ runs.salts[start]
            order, new = distinct(one, two)
            begin = np.flatnonzero(new)
            often = np.diff(np.append(begin, len(order)))
            begin = order[begin]
            real = stay.among(one[begin] >> _U(64 - _bits(blocks)))
            begin, often = begin[real], often[real]
            found.append((
                one[begin], two[begin], often, np.full(len(begin), length, np.int32), own[start[begin]],
                _texts(runs, start[begin], length),
            ))
            waiting += len(begin)
        if waiting > MERGE:
            found = [_merged(found)]
            waiting = 0
    if found:
        _, _, sums, length, lang, texts = _merged(found)
        made = [
            languages.dictionary.take(pa.array(lang)), pa.array(length), texts.cast(pa.string()),
            pa.array(sums.astype(np.int64)),
        ]
    else:
        made = [pa.array([], t) for t in (pa.string(), pa.int32(), pa.string(), pa.int64())]
    totals = list(zip(languages.dictionary.to_pylist(), n_words.tolist(), strict=True))
    names = ["lang", "n_words", "phrase", "n"]
    return pa.concat_tables([
        pa.table(made, names=names),
        pa.table([
            pa.array([k for k, _ in totals], pa.string()), pa.array([0] * len(totals), pa.int32()),
            pa.array([""] * len(totals), pa.string()), pa.array([n for _, n in totals], pa.int64()),
        ], names=names),
    ])


def frequent(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """``lang, n_words, phrase, n``: all runs of up to ``longest`` words that occur ``least`` times or
    more in a language; and in the row of no words the number of its words."""
    dealt = deal(docs, F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
    blocks = blocks_for(text_bytes(dealt) / _BYTES_A_RUN)
    sent = each_part(dealt, lambda d, _: _send(d, longest, least, blocks), SENT)
    answers = ask(sent, lambda got: _judge(got, least), "runs")
    counted = each_part(dealt, lambda d, a: _count(d, a, longest, blocks), COUNTED, answers)
    return (
        counted.groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) | (F.col("n_words") == 0))
    )


def _part(first: str, length: str) -> str:
    return f"array_join(slice(words, {first}, {length}), ' ')"


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``a``, ``l`` and ``r`` are the counts of the phrase and of the two parts of its worst cut, ``n`` of
    the language's words; the score is ``floor(1000000 a a / (l r))``, in exact decimals. A
    phrase is left out if one that is longer and contains it has ``share`` percent of its count or more.
    """
    runs = stage(frequent(docs, longest, least), "frequent-runs")
    phrases = runs.filter("n_words > 1").selectExpr("lang", "phrase", "n as a", "n_words", "split(phrase, ' ') as words")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).selectExpr(
        "lang", "phrase", "a", "k", f"{_part('1', 'k')} as first", f"{_part('k + 1', 'n_words - k')} as rest"
    )
    known = runs.filter("n_words > 0")
    score = "cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * 1000000 div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))"
    scored = (
        cut.join(known.selectExpr("lang", "phrase as first", "n as l"), ["lang", "first"])
        .join(known.selectExpr("lang", "phrase as rest", "n as r"), ["lang", "rest"])
        .withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
    )
    inside = (
        phrases.filter("n_words > 2")
        .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)))
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("m") + 1)))
        .groupBy("lang", F.expr(_part("i", "m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    own = (
        scored.join(inside, ["lang", "phrase"], "left")
        .filter(f"longer is null or 100 * longer < {int(share)} * a")
        .select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES))).orderBy(*best)
    own = own.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    whole = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    total = runs.filter("n_words = 0").select("lang", F.col("n").alias("n"))
    return whole.filter(F.col("rank") <= top).join(total, "lang").selectExpr(
        "lang", "cast(rank as bigint) as rank", "phrase", "a", "l", "r", "n", "score"
    )
