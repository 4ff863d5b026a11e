"""Numpy kernel shared by the text operators: words, word hashes, windows and minimisers of Arrow string batches.

Works on whole texts.  A batch is cut into chunks of whole documents of at most about ``CHUNK_BYTES`` bytes (one longer
document is a chunk of its own), so memory follows the longest document and not the batch.

* A word is a maximal run of bytes marked in a 256-entry table (multi-byte UTF-8 characters are runs of bytes
  from 0x80 on, so byte tables express the character classes used here).
* A word of up to 16 bytes is read as two numbers, which are mixed.  A longer one is hashed by two polynomials over
  random byte values, each modulo the prime 2^31 - 1 and with a base of its own, read off prefix sums; the 62 bits are
  finalised.  (Modulo a power of two, texts like the Thue-Morse word and its complement agree under every base.)
* A window's hash is two such polynomials over word hashes; ``window_hashes`` gives two values of independent bits.
* A minimiser is the least k-gram of a window; consecutive windows share theirs, so about 2 / (length - k + 2) of all
  positions are minimisers.

Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 500_000

_rng = np.random.Generator(np.random.PCG64(20240607))
_PRIME = 2**31 - 1
_P, _P_BITS = np.uint64(_PRIME), np.uint64(31)
_BYTE_VALUE = _rng.integers(1, _PRIME, size=(2, 256), dtype=np.uint64)
#: Two bases each for words, windows, and windows a second time.
_BASES = tuple(int(x) for x in _rng.integers(2**20, _PRIME - 1, size=6))
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([256**i - 1 for i in range(9)], dtype=np.uint64)
_SALT, _ODD = (np.uint64(int(x) | 1) for x in _rng.integers(2**60, 2**63, size=2))
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Word characters: everything but space and 0x09-0x0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word characters: digits, lower-case letters and everything beyond ASCII (texts are lower-cased first).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
#: A-Z to a-z, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any 64-bit x: its parts of 31 bits are added up.  Works in the array that is given."""
    for _ in range(2):
        high = x >> _P_BITS
        x &= _P
        x += high
    np.subtract(x, _P, out=x, where=x >= _P)
    return x


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo the prime for i < n (kept and grown on demand)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, n.bit_length())
        tables = []
        for b in (base, pow(base, -1, _PRIME)):
            p = np.ones(1, dtype=np.uint64)
            while len(p) < size:
                p = np.concatenate([p, _mod(p * np.uint64(pow(b, len(p), _PRIME)))])
            tables.append(p.astype(np.uint32))
        have = _powers[base] = (tables[0], tables[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit values (invertible, so it adds no collisions)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _ranges(values: np.ndarray, base: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[lo:hi] (values below the prime) for each pair: 31 bits, not finalised."""
    power, inverse = _power_tables(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(_mod(values * power[: len(values)]), out=prefix[1:])  # below 2^31 each, so 2^33 of them fit
    return _mod(_mod(prefix[hi] - prefix[lo]) * inverse[lo])


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one << _P_BITS) | two


@dataclass
class Words:
    """Words of consecutive documents: rows first..first+n_docs of the batch; words of document i are indptr[i]:indptr[i+1]."""

    first: int
    n_docs: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    indptr: np.ndarray
    text_offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.indptr)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def first_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Each word's first and second 8 bytes as numbers."""
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(16, dtype=np.uint8)])
        eight = np.ndarray(len(self.data) + 9, dtype="<u8", buffer=padded, strides=(1,))  # the 8 bytes from every byte on
        low = eight[self.start] & _FIRST[np.minimum(size, 8)]
        high = eight[np.minimum(self.start + 8, len(self.data))] & _FIRST[np.clip(size - 8, 0, 8)]
        return low, high

    def word_hashes(self) -> np.ndarray:
        size = self.end - self.start
        low, high = self.first_bytes()
        h = mix(mix(low + _SALT) + high * _ODD + size.astype(np.uint64))
        long = np.flatnonzero(size > 16)
        if len(long):
            length = size[long]
            begin = np.r_[0, np.cumsum(length)]
            data = self.data[np.repeat(self.start[long] - begin[:-1], length) + np.arange(begin[-1])]
            one, two = (_ranges(_BYTE_VALUE[i][data], _BASES[i], begin[:-1], begin[1:]) for i in range(2))
            h[long] = mix(_pair(one, two) + (length.astype(np.uint64) << np.uint64(62)))
        return h

    def fits(self, length: int) -> np.ndarray:
        """For each word: do ``length`` words starting here stay in its document?"""
        n = int(self.indptr[-1])
        last = np.repeat(self.indptr[1:], self.counts)
        return np.arange(n) + length <= last


def string_chunks(column: pa.Array | pa.ChunkedArray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of runs of whole rows."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    base = 0
    for part in parts:
        if len(part) == 0:
            continue
        if part.null_count:
            part = part.fill_null("")
        if pa.types.is_large_string(part.type) or pa.types.is_large_binary(part.type):
            width = np.int64
        else:
            width = np.int32
        buffers = part.buffers()
        offsets = np.frombuffer(buffers[1], dtype=width)[part.offset: part.offset + len(part) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
        i = 0
        while i < len(part):
            j = int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1
            j = min(len(part), max(j, i + 1))
            yield base + i, offsets[i: j + 1] - offsets[i], data[offsets[i]: offsets[j]]
            i = j
        base += len(part)


def words_of(column: pa.Array | pa.ChunkedArray, table: np.ndarray = SPACED, lower: bool = False,
             chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column, chunk by chunk."""
    for first, offsets, data in string_chunks(column, chunk_bytes):
        if lower:
            data = LOWER[data]
        n = len(data)
        word = table[data]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        before = np.zeros(n, dtype=bool)
        before[1:] = word[:-1]
        before[inner] = False
        after = np.zeros(n, dtype=bool)
        after[:-1] = word[1:]
        after[inner - 1] = False
        start = np.flatnonzero(word & ~before)
        end = np.flatnonzero(word & ~after) + 1
        yield Words(first, len(offsets) - 1, data, start, end, np.searchsorted(start, offsets), offsets)


def window_hashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, second: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Two independent hashes of hashes[lo:hi] for each pair, the length included."""
    size = (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = []
    for i in range(2 if second else 1):
        bits = mix(hashes + np.uint64(i + 1))  # other bits of the words for every polynomial
        low, high = _mod(bits & np.uint64(0xFFFFFFFF)), _mod(bits >> np.uint64(32))
        out.append(mix(_pair(_ranges(low, _BASES[2 + 2 * i], lo, hi), _ranges(high, _BASES[3 + 2 * i], lo, hi)) ^ size))
    return out[0], out[1] if second else None


def minimisers(words: Words, hashes: np.ndarray, k: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each window of ``length`` words inside a document is owned by its least k-gram (the leftmost of equal ones).

    Returns, per owner in text order: its word position in the chunk, its k-gram hash, and the first and last start of
    the windows that it owns.  Equal windows are owned by the same k-gram at the same offset, wherever they stand.
    """
    n = len(hashes)
    at = np.arange(n)
    whole = np.flatnonzero(words.fits(length))
    if not len(whole):
        none = np.zeros(0, dtype=np.int64)
        return none, np.zeros(0, dtype=np.uint64), none, none
    grams = np.full(n, MAX64, dtype=np.uint64)
    lo = at[words.fits(k)]
    grams[lo] = window_hashes(hashes, lo, lo + k, second=False)[0]
    least, size, w = at, 1, length - k + 1
    while size < w:
        step = min(size, w - size)
        other = least[step:]
        mine = least[: n - step]
        least = np.append(np.where(grams[other] < grams[mine], other, mine), least[max(0, n - step):])
        size += step
    owner = least[whole]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1] + 1)])
    first = whole[new]
    last = whole[np.append(new[1:], len(whole)) - 1]
    return owner[new], grams[owner[new]], first, last
