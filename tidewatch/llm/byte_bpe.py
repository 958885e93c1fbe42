"""Token ids of many texts under a byte-level BPE model, each distinct unit tokenized once.

The model's splitting pattern never joins characters over certain places: the edges of white space, where a
single blank goes with the word after it, and a change between ASCII letters or digits and ASCII
punctuation. Texts are cut there into units, and the units of a slice become an Arrow dictionary, so that only
those not seen before are tokenized. What the two tokenizer libraries might split differently
(characters outside `_PLAIN`) and texts with rare white space or with special tokens go to the model's own
library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewatch.llm.arrays import Slice, slices

#: Texts are taken in slices of about so many bytes; so many units are remembered.
CHUNK, KNOWN = 4 << 20, 1 << 20

#: The splitting pattern of the model family, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters whose kind (letter, number, other) has not changed since Unicode 5.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧€Α-Ωα-ωА-яぁ-ゖァ-ヺ一-龥가-힣]*")

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 13, 32]] = True
_KIND = np.zeros(256, np.uint8)  # 1: letter or digit, 2: punctuation, 0: goes with either
for _b in range(33, 127):
    _KIND[_b] = 1 if chr(_b).isalnum() else 2
_KIND[ord("'")] = 0
_RARE_LEAD = np.zeros(256, bool)
_RARE_LEAD[[0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


def _bytes_of_characters() -> dict[str, int]:
    """The character that stands for each byte in the model file: printable ones for themselves, the
    others in order from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def unit_starts(part: Slice) -> np.ndarray:
    """Where units begin; every document begins one."""
    data, n = part.data, len(part.data)
    begins = np.zeros(n + 1, bool)
    begins[part.offsets] = True
    if not n:
        return np.zeros(0, np.int64)
    white, kind = _WHITE[data], _KIND[data]
    inside = ~begins[1:n]  # not the first byte of a document
    last = np.append(white[1:], True)  # white after it, or the end of its document
    last[part.offsets[1:][part.offsets[1:] > 0] - 1] = True
    cut = np.zeros(n, bool)
    # after white space: a word, unless a blank goes with it; before white space: where a run begins, and
    # before the last of a run that a word follows
    cut[1:] = inside & np.where(
        white[1:], ~white[:-1] | ~last[1:], (white[:-1] & (data[:-1] != 32)) | (kind[1:] * kind[:-1] == 2)
    )
    cut |= begins[:n]
    return np.flatnonzero(cut)


def rare_places(data: np.ndarray) -> np.ndarray:
    """Where there is white space other than blank, tab, line feed and carriage return, or a character that
    some take for it."""
    at = np.flatnonzero(_RARE_LEAD[data])
    one = data[at]
    two, three = (np.append(data, np.zeros(2, np.uint8))[at + i] for i in (1, 2))
    rare = one < 0x20
    rare |= (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    rare |= (one == 0xE1) & (((two == 0x9A) & (three == 0x80)) | ((two == 0xA0) & (three == 0x8E)))
    rare |= (one == 0xE2) & (two == 0x80) & ((three <= 0x8F) | ((three >= 0xA8) & (three <= 0xAF)))
    rare |= (one == 0xE2) & (two == 0x81) & (three >= 0x9F) & (three <= 0xAF)
    rare |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
    rare |= (one == 0xEF) & (two == 0xBB) & (three == 0xBF)
    return at[rare]


def _offsets_and_bytes(units: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    _, place, data = units.buffers()
    offsets = np.frombuffer(place, np.int64, len(units) + 1, 8 * units.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


class Encoder:
    """``Encoder(file)(column)`` gives ``(first, ids, offsets)`` for slices of a text column."""

    def __init__(self, model_file: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(model_file, encoding="utf-8") as f:
            model = json.load(f)
        self.own = Tokenizer.from_file(model_file)
        self.special = [x["content"].encode() for x in model["added_tokens"]]
        vocabulary, split = model["model"]["vocab"], model["pre_tokenizer"]
        byte = _bytes_of_characters()
        ranks = {bytes(byte[c] for c in x): i for x, i in vocabulary.items() if x.encode() not in self.special}
        merged = [bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in model["model"]["merges"]]
        if (
            split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
            or model["normalizer"] or [ranks[m] for m in merged] != sorted(ranks[m] for m in merged)
        ):
            raise ValueError(f"{model_file} is no plain byte-level BPE model")
        self.fast = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for x, i in ranks.items():
            self.width[i] = len(x)
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # ids of known units, in self.ids
        self.ids = np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)

    def _in_a_row(self, units: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units that follow one another as in a text, and how many each has. The edges of units
        come from the widths of the ids."""
        offsets, data = _offsets_and_bytes(units)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(units), np.int64)
        # a unit that does not begin with a blank follows a line end, which is a unit of its own
        lead = data[offsets[:-1]] != 32
        text = np.insert(data, offsets[:-1][lead], 10).tobytes().decode()
        ids = self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        edge, end = np.cumsum(self.width[ids]), offsets[1:] + np.cumsum(lead)
        last = np.searchsorted(edge, end) + 1
        if (edge[last - 1] != end).any():
            raise ValueError("the model joins characters over the edge of a unit")
        keep = np.ones(len(ids), bool)
        keep[np.concatenate(([0], last[:-1]))[lead]] = False
        return ids[keep], np.diff(last, prepend=0) - lead

    def _learn(self, units: pa.LargeBinaryArray) -> None:
        """Tokenize units and remember them."""
        offsets, data = _offsets_and_bytes(units)
        odd = _WHITE[data[offsets[1:] - 1]]
        for i in np.flatnonzero(np.maximum.reduceat(data, offsets[:-1]) >= 0x80).tolist():
            odd[i] = odd[i] or not _PLAIN.fullmatch(units[i].as_py().decode())
        plain = units.filter(pa.array(~odd))
        ids, sizes = self._in_a_row(plain)
        others = [self.whole(x.decode()) for x in units.filter(pa.array(odd)).to_pylist()]
        sizes = np.concatenate((sizes, np.array([len(x) for x in others], np.int64)))
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.ids = np.concatenate([self.ids, ids, *others])
        self.known = pa.concat_arrays([self.known, plain, units.filter(pa.array(odd))])

    def _rows(self, units: pa.LargeBinaryArray) -> np.ndarray:
        """The row of each unit among those known."""
        coded = units.dictionary_encode()
        place = pc.index_in(coded.dictionary, self.known)
        if place.null_count:
            if len(self.known) + place.null_count > KNOWN:
                self._forget()
                place = pc.index_in(coded.dictionary, self.known)
            self._learn(coded.dictionary.filter(place.is_null()))
            place = pc.index_in(coded.dictionary, self.known)
        return place.to_numpy()[coded.indices.to_numpy()]

    def _slice(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, and where each document's begin."""
        start = unit_starts(part)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(part.offsets), np.int64)
        edges = np.append(start, len(part.data)).astype(np.int64)
        row = self._rows(
            pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(part.data)])
        )
        size = self.size[row]
        end = np.cumsum(size)
        ids = self.ids[np.repeat(self.begin[row] - (end - size), size) + np.arange(int(end[-1]))]
        offsets = np.concatenate(([0], end))[np.searchsorted(start, part.offsets)]
        data, apart = part.data.tobytes(), rare_places(part.data).tolist()
        for token in self.special:
            at = data.find(token)
            while at >= 0:
                apart.append(at)
                at = data.find(token, at + 1)
        if apart:
            pieces = [ids[a:b] for a, b in pairwise(offsets.tolist())]
            for d in np.unique(np.searchsorted(part.offsets, apart, "right") - 1).tolist():
                pieces[d] = self.whole(data[part.offsets[d] : part.offsets[d + 1]].decode())
            ids = np.concatenate(pieces)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        return ids, offsets

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for part in slices(column, CHUNK):
            ids, offsets = self._slice(part)
            yield part.first, ids, offsets

    def documents(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        for _, ids, offsets in self(column):
            coded = ids.astype("<u4").tobytes()
            for a, b in pairwise(offsets.tolist()):
                yield coded[4 * a : 4 * b]
