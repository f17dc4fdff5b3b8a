"""Word hashes of many texts at once, as numpy work inside a task.

A word's hash is a polynomial of its bytes modulo 2^64 over a table of random byte values, taken as
a difference of two running sums, then mixed. Texts are joined and cut into pieces of bounded size
at white space, so memory does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    powers = np.full(PIECE + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    inverse = np.full(PIECE + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    return values, space, np.cumprod(powers), np.cumprod(inverse)


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts that end at white space, or a longer part where a word is longer than a piece."""
    start, end = 0, len(data)
    space = _tables()[1]
    while start < end:
        stop = min(start + PIECE, end)
        if stop < end:
            found = np.flatnonzero(space[np.frombuffer(data, np.uint8, stop - start, start)])
            if len(found):
                stop = start + int(found[-1]) + 1
            else:
                while stop < end:
                    part = np.frombuffer(data, np.uint8, min(PIECE, end - stop), stop)
                    found = np.flatnonzero(space[part])
                    if len(found):
                        stop += int(found[0]) + 1
                        break
                    stop += len(part)
        yield data[start:stop]
        start = stop


def _long_hash(word: bytes) -> int:
    """The hash of one word of any length, piece by piece."""
    values, _, powers, _ = _tables()
    total, factor = 0, 1
    for at in range(0, len(word), PIECE):
        part = values[np.frombuffer(word[at : at + PIECE], np.uint8)]
        total = (total + factor * int((part * powers[: len(part)]).sum(dtype=np.uint64))) & _MASK
        factor = factor * pow(_BASE, PIECE, 1 << 64) & _MASK
    return total


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a piece, and their starts."""
    values, space, powers, inverse = _tables()
    if len(data) > PIECE:
        words = data.split()
        starts, at = [], 0
        for word in words:
            at = data.index(word, at)
            starts.append(at)
            at += len(word)
        raw = np.array([_long_hash(w) for w in words], dtype=np.uint64)
        return mix(raw), np.array(starts, dtype=np.int64)
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~space[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(values[raw] * powers[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lower-cased, and the offsets of each text's words.

    Null texts have no words.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    lengths = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    data = b"\n".join([*raw, b""])
    hashes, places, at = [], [], 0
    for piece in _pieces(data):
        h, s = _hash_piece(piece)
        hashes.append(h)
        places.append(s + at)
        at += len(piece)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), bounds)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence where it is shorter."""
    if not len(words):
        return words[:0]
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mix(out + words[k : k + n] + np.uint64(k + 1))
        return mix(out + np.uint64(width))


def batches_of(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters each; a longer text is a range of its own."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
