"""Hashes of the words of whole Arrow batches, without a Python step per word.

A word's hash is a polynomial in its bytes modulo 2^64 with a random value for each byte, taken as the difference of two running
sums, so a batch costs a few passes over its bytes. Words above 64 bytes, where such polynomials could be made to agree, are
hashed by xxh3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2, M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_WINDOW = 1 << 18
_LONG = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(_WINDOW + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * M3)
_FOLDED = _LETTER.copy()
_FOLDED[65:91] = _LETTER[97:123]
_tables: list[np.ndarray] = []


def spaces(part: np.ndarray) -> np.ndarray:
    return (part == 32) | ((part - np.uint8(9)) < 5)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary array and where each text starts and the last ends; a null has none."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def _windows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of at most _WINDOW bytes that no word crosses; a longer word is a stretch of its own."""
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = min(lo + _WINDOW, end)
        if hi < end:
            border = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            gaps = np.flatnonzero(spaces(data[lo:hi]))
            cut = max(border, lo + int(gaps[-1]) + 1 if len(gaps) else lo)
            if cut == lo:  # one word: to its end
                last = int(offsets[np.searchsorted(offsets, lo, "right")])
                cut = hi
                while cut < last:
                    gaps = np.flatnonzero(spaces(data[cut : min(cut + _WINDOW, last)]))
                    cut = cut + int(gaps[0]) if len(gaps) else min(cut + _WINDOW, last)
                    if len(gaps):
                        break
            hi = cut
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each text. Words are what ASCII white space leaves; fold lower-cases
    A-Z."""
    from xxhash import xxh3_64_intdigest

    if not _tables:
        _tables.extend((_powers(_BASE), _powers(_INVERSE)))
    power, inverse = _tables
    letter = _FOLDED if fold else _LETTER
    whole = lambda a, b: xxh3_64_intdigest(data[a:b].tobytes().lower() if fold else data[a:b].tobytes())
    hashes, places = [], []
    for lo, hi in _windows(data, offsets):
        if hi - lo > _WINDOW:
            hashes.append(np.array([whole(lo, hi)], np.uint64))
            places.append(np.array([lo]))
            continue
        part = data[lo:hi]
        word = ~spaces(part)
        borders = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
        before, after = np.zeros(len(part), bool), np.zeros(len(part), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[borders] = False
        after[borders - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(letter.take(part, mode="clip") * power[: len(part)], out=sums[1:])
        size = (ends - starts).astype(np.uint64)
        h = mixed((sums[ends] - sums[starts]) * inverse[starts] + size * M3)
        for i in np.flatnonzero(size > _LONG):
            h[i] = whole(lo + int(starts[i]), lo + int(ends[i]))
        hashes.append(h)
        places.append(starts + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(places), offsets, "left"))


def slices(texts: pa.Array, most: int = 1 << 23) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """flat() in runs of consecutive texts of about `most` bytes, so the memory for a batch of long texts stays bounded."""
    data, offsets = flat(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield data, offsets[i : j + 1]
        i = j


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    if len(x) < 2:
        return x
    new = np.empty(len(x), bool)
    new[0] = True
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def gram_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word n-grams, A-Z lower-cased. With fewer words than `size` the whole
    sequence is one n-gram; without words there is none."""

    def of(h: np.ndarray, n: int, key: int) -> np.ndarray:
        out = np.full(len(h) - n + 1, key, np.uint64)
        for i in range(n):
            out = mixed(out * M3 + h[i : len(h) - n + 1 + i])
        return out

    for data, offsets in slices(texts):
        h, counts = word_hashes(data, offsets)
        grams = of(h, size, 0) if len(h) >= size else h[:0]
        end = 0
        for n in counts.tolist():
            start, end = end, end + n
            yield distinct(grams[start : end - size + 1]) if n >= size else of(h[start:end], n, n) if n else h[:0]
