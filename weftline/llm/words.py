"""Words of Arrow text columns as 64-bit hashes, in whole numpy steps.

A word is a run of bytes other than blank and the five control characters from tab on, which in UTF-8 is the same as for
characters. Its hash is a sum of random byte values times powers of an odd number, mixed; equal words have equal hashes, and
two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers spread over all places; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the number and of its inverse; those of a long text are not kept."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1]
    size = max(n, 1 << 20)
    found = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, _BACK))
    if size == 1 << 20:
        _powers = found
    return found[0][:n], found[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins and the last ends; null rows are empty."""
    if pa.types.is_string_view(texts.type):
        texts = texts.cast(pa.large_string())
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if texts.null_count:  # a null row may still have bytes below it
        lengths = np.where(np.asarray(texts.is_valid()), np.diff(offsets), 0)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        keep = [whole[o : o + n] for o, n in zip(offsets[:-1].tolist(), lengths.tolist(), strict=True)]
        return np.concatenate([*keep, np.zeros(0, np.uint8)]), np.r_[0, np.cumsum(lengths)]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts in a row: `bounds[i]:bounds[i+1]` are those of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    n = len(data)
    solid = ~_SPACES[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if n:
        powers, back = _up_to(n)
        values = _TABLE[_LOWER[data] if lower else data]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers, out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * back[starts])
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets).astype(np.int64), data, offsets)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each row of n neighbours; shorter by n - 1."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    size = len(hashes) - n + 1
    out = np.full(size, np.uint64(n))
    for i in range(n):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + size])
    return out


def shingles(found: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rows of n words in each text, and the bounds per text; a shorter text is one row, an empty one none."""
    counts = found.counts
    every = runs(found.hashes, n)
    per = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.r_[0, np.cumsum(per)]
    inside = np.repeat(found.bounds[:-1] - bounds[:-1], per) + np.arange(bounds[-1])
    out = np.zeros(bounds[-1], np.uint64)
    owner = np.repeat(np.arange(len(counts)), per)
    long = (counts >= n)[owner]
    out[long] = every[inside[long]]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        out[bounds[i]] = runs(found.hashes[found.bounds[i] : found.bounds[i + 1]], int(counts[i]))[0]
    return out, bounds
