"""Words and word hashes of many texts at once, with numpy inside Spark tasks.

Texts are joined to byte chunks of bounded size. A word is a run of word bytes; its hash mixes its blocks of eight bytes
one after the other, for all words of a chunk at once. Words of more than `LONG_WORD` bytes are hashed one by one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: Bytes up to which words are hashed side by side.
LONG_WORD = 256
# A window's polynomial is modulo 2**64 over word hashes that are mixed already. Modulo a power of two, polynomials are weak
# against regular patterns of some thousand places; windows and shingles have at most some dozen.
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_WORD_BASE_INVERSE = pow(_WORD_BASE, -1, 1 << 64)

#: Words without ASCII white space: `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Letters, digits and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept per process and grown on demand."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= CHUNK_BYTES + 1:
            _powers[base] = held
    return held[:n]


class Words(NamedTuple):
    """The words of a chunk: hashes, byte ranges in `data`, and the first word of each text (one more at the end)."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)


def _word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per byte range."""
    lengths = (ends - starts).astype(np.int64)
    hashes = mixed(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    blocks = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))  # the eight bytes from each place on
    alive = np.flatnonzero(lengths <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        alive = alive[lengths[alive] > at]
        if not len(alive):
            break
        spare = np.uint64(8) * (8 - np.minimum(lengths[alive] - at, 8)).astype(np.uint64)
        block = blocks[starts[alive] + at] << spare >> spare
        hashes[alive] = mixed(hashes[alive] * np.uint64(0xD1342543DE82EF95) + block)
    for k in np.flatnonzero(lengths > LONG_WORD):
        digest = blake2b(memoryview(data)[starts[k] : ends[k]], digest_size=8).digest()
        hashes[k] = int.from_bytes(digest, "little")
    return hashes


def words_of(texts: Sequence[bytes], word_bytes: np.ndarray = SPACED, fold_case: bool = False) -> Words:
    """The words of some texts. A space between texts keeps them apart; it is a word byte in no table."""
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    inside = np.empty(len(data) + 1, np.int8)
    inside[0] = 0
    inside[1:] = word_bytes[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    hashes = _word_hashes(_LOWER[data].tobytes() if fold_case else joined, starts, ends)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return Words(hashes, starts, ends, np.searchsorted(starts, begins), data)


def beginnings(words: Words, size: int, fold_case: bool = False) -> np.ndarray:
    """Hashes of the first `size` (at most 8) bytes of each word."""
    packed = np.zeros(len(words.starts), np.uint64)
    fold = np.arange(256, dtype=np.uint64)
    if fold_case:
        fold[0x41:0x5B] += 32
    for k in range(size):
        at = np.minimum(words.starts + k, words.ends)
        packed |= np.where(at < words.ends, fold[words.data[at]], np.uint64(0)) << np.uint64(8 * k)
    return mixed(packed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size))


def chunks(texts: Sequence[bytes], size: int = CHUNK_BYTES) -> Iterator[slice]:
    """Ranges of texts of at most `size` bytes together; a longer text stands alone and whole."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield slice(begin, i)
            begin, total = i, 0
        total += len(text) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def give_back() -> None:
    """Return to the system what this process has freed: workers live on beside those of later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task that gives its memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def windows(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of every `width` consecutive words of one text, and the first word of each window."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * powers(_WORD_BASE, n), out=sums[1:])
    rolled = (sums[width:] - sums[:-width]) * powers(_WORD_BASE_INVERSE, n - width + 1)
    valid = np.ones(n - width + 1, bool)
    for end in firsts[1:-1]:  # windows that would run over the end of a text
        valid[max(0, end - width + 1) : end] = False
    at = np.flatnonzero(valid)
    return mixed(rolled[at]), at


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row and the first shingle of each text (one more at the end).

    A text of fewer words, but not none, is one shingle of all its words; a text without words has none.
    """
    rolled, at = windows(words.hashes, words.firsts, width)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.array(
            [
                np.sum(words.hashes[a : a + n] * powers(_WORD_BASE, n), dtype=np.uint64) + np.uint64(n)
                for a, n in zip(words.firsts[short], counts[short], strict=True)
            ],
            np.uint64,
        )
        rolled, at = np.concatenate([rolled, mixed(whole)]), np.concatenate([at, words.firsts[short]])
        order = np.argsort(at, kind="stable")
        rolled, at = rolled[order], at[order]
    return rolled, np.searchsorted(at, words.firsts)


def planar(values: np.ndarray) -> bytes:
    """Whole numbers as one plane per byte: the high planes are nearly constant and compress away."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planar(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
