"""Words of many texts at once as numpy arrays.

Texts lie behind one another in one byte buffer. Word boundaries come from
byte masks and word hashes from prefix sums of a polynomial, so no loop runs
over words. The polynomial is taken modulo two primes: modulo a power of two,
crafted words (Thue-Morse strings) would share a hash whatever the base.
Callers pass slices of bounded size, or one text that is larger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
#: Prime and base of each half of a word's hash.
FIELDS = (((1 << 31) - 1, 0x5BD1E995), ((1 << 31) - 19, 0x1B873593))
#: Words from this many bytes on are hashed apart: sums of shorter ones fit into 64 bits.
LONG_WORD = 1 << 24

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20

#: Text bytes handled together, unless one text alone is larger.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """First ``n`` powers of each base and of its inverse, modulo its prime."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        made = []
        for prime, base in FIELDS:
            for step in (base, pow(base, -1, prime)):
                steps = np.ones(1, np.uint64)
                while len(steps) < size:
                    steps = np.concatenate([steps, steps * np.uint64(pow(step, len(steps), prime)) % np.uint64(prime)])
                made.append(steps[:size].astype(np.uint32))
        _powers[:] = made
    return [p[:n] for p in _powers]


@dataclass
class Words:
    """Words of consecutive texts: byte range, hash and text number of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray
    bounds: np.ndarray  # word range of text i: bounds[i] to bounds[i + 1]

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``width`` words and its first word, in order."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        whole = np.flatnonzero(self.texts[:n] == self.texts[width - 1 :])
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = total * np.uint64(BASE) + self.hashes[k : k + n]
        return mix(total[whole]), whole


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of the texts ``data[offsets[i]:offsets[i + 1]]``, in order."""
    n = len(data)
    space = IS_SPACE[data]
    first = np.ones(n + 1, bool)
    first[1:n] = space[: n - 1] if n else False
    first[offsets] = True  # a text starts; also marks the end of the one before
    last = first[1:] | np.append(space[1:], True) if n else np.zeros(0, bool)
    return np.flatnonzero(~space & first[:n]), np.flatnonzero(~space & last) + 1


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; A-Z folded if ``lower``."""
    if lower:
        data = LOWERED[data]
    n = len(data)
    starts, ends = word_bounds(data, offsets)
    letters, steps = data.astype(np.uint64) + np.uint64(1), powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    hashes = np.zeros(len(starts), np.uint64)
    for k, (prime, _) in enumerate(FIELDS):
        up, down = steps[2 * k : 2 * k + 2]
        np.cumsum(letters * up[:n], out=prefix[1:])
        half = (prefix[ends] - prefix[starts]) % np.uint64(prime) * down[starts] % np.uint64(prime)
        hashes |= half << np.uint64(32 * k)
    hashes = mix(hashes)
    for i in np.flatnonzero(ends - starts >= LONG_WORD):
        name = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
        hashes[i] = int.from_bytes(name, "little")
    texts = np.searchsorted(offsets, starts, side="right") - 1
    bounds = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hashes, texts, bounds)


def text_slices(
    texts: pa.Array, most: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of about ``most`` bytes; null is empty."""
    plain = texts.cast(pa.large_binary())
    if plain.null_count:
        plain = plain.fill_null(b"")
    n = len(plain)
    if n == 0:
        return
    _, offset_buffer, data_buffer = plain.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[plain.offset : plain.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes and the text of each; a text of fewer words is one shingle.

    Texts without words have none. Repeats within a text are kept.
    """
    hashes, first = words.windows(width)
    texts = words.texts[first]
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            at = np.minimum(words.bounds[short] + k, len(words.hashes) - 1)
            extra = np.where(has, extra * np.uint64(BASE) + words.hashes[at], extra)
        extra = mix(extra ^ counts[short].astype(np.uint64))
        hashes = np.concatenate([hashes, extra])
        texts = np.concatenate([texts, short])
        order = np.argsort(texts, kind="stable")
        hashes, texts = hashes[order], texts[order]
    return hashes, texts


def distinct_shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles by text, sorted within each, and their bounds per text."""
    hashes, texts = shingles(words, width)
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    hashes, texts = hashes[fresh], texts[fresh]
    return hashes, np.searchsorted(texts, np.arange(len(words.bounds)))
