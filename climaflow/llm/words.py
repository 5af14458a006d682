"""Words of a column of texts as arrays of 64-bit hashes, without a Python object per word.

A text column arrives as one byte buffer with offsets. Word edges are found by a table over bytes, and the hash of each
word is a difference of running sums of ``value(byte) * B^position``, scaled back by ``B^-start`` (modulo 2^64) and
mixed with the length. Separators are ASCII, so edges never fall inside a UTF-8 character. Upper- and lower-case ASCII
letters have the same value where case is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass(frozen=True, eq=False)
class Alphabet:
    """Which bytes belong to words, and the value of each byte in a hash."""

    in_word: np.ndarray
    value: np.ndarray


@lru_cache
def white_space_words(fold_case: bool = True) -> Alphabet:
    """Words between bytes 0x20 and 0x09 to 0x0D; A-Z count as a-z if ``fold_case``."""
    in_word = np.ones(256, bool)
    in_word[[0x20, *range(0x09, 0x0E)]] = False
    value = _byte_values()
    if fold_case:
        value[65:91] = value[97:123]
    return Alphabet(in_word, value)


@lru_cache
def letter_words() -> Alphabet:
    """Words of ASCII letters, digits and all bytes beyond ASCII; A-Z count as a-z."""
    in_word = np.zeros(256, bool)
    in_word[128:] = in_word[48:58] = in_word[65:91] = in_word[97:123] = True
    value = _byte_values()
    value[65:91] = value[97:123]
    return Alphabet(in_word, value)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, back, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass(frozen=True, eq=False)
class Chunk:
    """Texts ``first`` to ``last`` (excluded) of a batch: their word hashes and each text's first word."""

    first: int
    last: int
    words: np.ndarray
    starts: np.ndarray  # one more than texts
    n_bytes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), self.counts)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not (pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)):
        texts = texts.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def hashed(data: np.ndarray, edges: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts that ``edges`` cut ``data`` into, and each text's first word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(edges), np.int64)
    inside = alphabet.in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = edges[(edges > 0) & (edges < n)]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(max(CHUNK_BYTES, 1 << int(n - 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(alphabet.value[data] * up[:n], out=total[1:])
    sums = (total[end] - total[begin]) * down[begin]
    words = mix(sums + (end - begin).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return words, np.searchsorted(begin, edges).astype(np.int64)


def chunks(texts: pa.Array, alphabet: Alphabet) -> Iterator[Chunk]:
    """Word hashes of a column, some texts at a time."""
    at, data = text_buffers(texts)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, n)
        edges = at[first:last + 1] - at[first]
        words, starts = hashed(data[at[first]:at[last]], edges, alphabet)
        yield Chunk(first, last, words, starts, np.diff(edges))
        first = last


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that begin at each word (the last ``length - 1`` have none)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out += words[k:k + n] * np.uint64(pow(0x2545F4914F6CDD1D, k + 1, 1 << 64))
    return mix(out)


def shingle_sets(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ``length`` words of every text: (text index, hash), sorted by both.

    A text of fewer words has its whole sequence as one; one without words has none.
    """
    counts = chunk.counts
    text = chunk.text_of_word
    whole = runs(chunk.words, length)
    same = text[:len(whole)] == text[length - 1:] if len(whole) else np.zeros(0, bool)
    of, sets = text[:len(whole)][same], whole[same]
    for i in np.flatnonzero((counts > 0) & (counts < length)):
        seq = chunk.words[chunk.starts[i]:chunk.starts[i + 1]]
        short = runs(seq, len(seq)) + np.uint64(len(seq))
        of, sets = np.append(of, i), np.append(sets, mix(short))
    order = np.lexsort((sets, of))
    of, sets = of[order], sets[order]
    if len(of):
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (sets[1:] != sets[:-1])
        of, sets = of[new], sets[new]
    return of, sets
