"""Arithmetic on many texts at once: words, spans and their hashes over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_MASK = (1 << 64) - 1

#: Odd multipliers of the polynomial hashes.
BASE, BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:  # doubling: p[done:2*done] = p[:done] * b**done
                p[done : 2 * done] = p[:done] * np.uint64(pow(b, done, 1 << 64))
                done *= 2
            out.append(p)
        have = _powers[base] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of (value + 1) * base**i; see span_hash()."""
    p, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * p, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], the same wherever the span stands."""
    _, inverse = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offs = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or offs[0] == offs[-1]:
        return np.zeros(0, np.uint8), offs - offs[0]
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def slices(array: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    _, offs = buffers(array)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word ``[^\\x20\\x09-\\x0D]+``; words end at document ends."""
    inside = ~_SEPARATOR[data]
    begins, ends = offs[:-1], offs[1:]
    full = ends > begins
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[begins[full]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[ends[full] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def per_document(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many positions of each document the mask holds."""
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the keys that occur more than once, and of those equal to an earlier key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, dtype=bool)
    same[1:-1] = k[1:] == k[:-1]
    twice, later = np.zeros(len(k), dtype=bool), np.zeros(len(k), dtype=bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later
