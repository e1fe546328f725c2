"""Words, shingles and rolling hashes of many texts at once, on their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_U = np.uint64
_codes = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_folded = np.arange(256)
_folded[65:91] += 32
FOLDED_CODES = _codes[_folded]
CODES = _codes
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, _U)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:n]


def sums(data: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes; ``span`` reads hashes of substrings from them."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(codes[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``, wherever they stand."""
    back = powers(INVERSE, len(prefix))
    return mixed((prefix[end] - prefix[start]) * back[start])


def parts(texts: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of ``most`` bytes or one text: number of the first, all bytes, offsets."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every word its text, start and end; ``between`` marks the bytes that no word has."""
    full = ~between[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a text's first byte follows on nothing
    starts = np.flatnonzero(full & (first[:-1] | ~np.concatenate(([False], full[:-1]))))
    ends = np.flatnonzero(full & (first[1:] | ~np.concatenate((full[1:], [False])))) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of ``k`` words, A-Z in lower case, its text and a hash; shorter texts have one run of all their words."""
    doc, starts, ends = words(data, offsets)
    hashes = span(sums(data, FOLDED_CODES), starts, ends)
    n = len(doc)
    left = np.bincount(doc, minlength=len(offsets) - 1)
    last = np.cumsum(left)  # one past a text's last word
    at = np.arange(n)
    head = at == (last - left)[doc]
    whole = at + k <= last[doc]
    at = at[whole | (head & (left[doc] < k))]
    out = np.zeros(len(at), _U)
    stop = last[doc[at]]
    for t in range(k):
        there = np.minimum(at + t, n - 1)
        out += np.where(at + t < stop, hashes[there], _U(t)) * powers(BASE, k)[t]
    return doc[at], mixed(out)


def weighted(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text with their weight, 1 + log2 of how often they occur, in order of text and hash."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], 1 + np.log2(np.diff(np.append(at, len(doc))))
