"""Word hashes of whole texts, computed with numpy straight on the UTF-8 bytes.

A word is a run of ``[0-9a-z]`` after A-Z are lower-cased, or of characters beyond ASCII. The hash of
a word is a polynomial over its bytes modulo 2**64, taken from one running sum over the text, then
mixed. No Python object is made per word, so a gigabyte takes seconds of CPU time.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
PIECE = 1 << 20            # bytes hashed at a time; a longer text is cut between words

LOWERED = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    if 65 <= _b <= 90:
        LOWERED[_b] = _b + 32
    elif 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        LOWERED[_b] = _b


class Words(NamedTuple):
    hashes: np.ndarray   # uint64
    starts: np.ndarray   # byte offsets in the buffer
    ends: np.ndarray
    first: np.ndarray    # index of each text's first word, and one more: the number of words


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up = np.full(n, BASE, dtype=np.uint64)
    up[0] = 1
    down = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    down[0] = 1
    table = np.random.default_rng(20240607).integers(1, 1 << 63, size=256, dtype=np.uint64) * _U(2) + _U(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down), table


def _hash_runs(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down, table = _powers(PIECE + 1)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = int(np.searchsorted(ends, at + PIECE, side="right"))
        if j <= i:  # one word longer than a piece: hash its pieces one after the other
            h = 0
            for k in range(at, int(ends[i]), PIECE):
                part = low[k:min(k + PIECE, int(ends[i]))]
                h = (h * 31 + int((table[part] * up[:len(part)]).sum(dtype=np.uint64))) % (1 << 64)
            out[i] = h
            i += 1
            continue
        sums = np.zeros(int(ends[j - 1]) - at + 1, dtype=np.uint64)
        part = low[at:int(ends[j - 1])]
        np.cumsum(table[part] * up[:len(part)], out=sums[1:])
        s = starts[i:j] - at
        out[i:j] = (sums[ends[i:j] - at] - sums[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _U(0x9FB21C651E98DF25))


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``raw[offsets[i]:offsets[i + 1]]``; texts do not run into each other."""
    n = len(raw)
    low = LOWERED[raw]
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = low != 0
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before, here = inside[:-1], inside[1:]
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    return Words(_hash_runs(low, starts, ends), starts, ends, np.searchsorted(starts, offsets))


def windows(tokens: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` tokens inside one text, and each text's first run.

    A text with fewer tokens, but at least one, has one run: all its tokens."""
    counts = np.diff(first)
    n_runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int64)
    out = np.empty(int(at[-1]), dtype=np.uint64)
    if len(tokens) >= width:
        h = np.zeros(len(tokens) - width + 1, dtype=np.uint64)
        for k in range(width):
            h = h * _U(0x9E3779B97F4A7C15) + tokens[k:len(tokens) - width + 1 + k]
        full = counts >= width
        keep = np.zeros(len(h) + 1, dtype=np.int64)
        np.add.at(keep, first[:-1][full], 1)
        np.add.at(keep, first[:-1][full] + n_runs[full], -1)
        inner = np.repeat(full, n_runs)
        out[inner] = mix(h[np.cumsum(keep[:-1]).astype(bool)])
    for t in np.flatnonzero((counts > 0) & (counts < width)):
        h = 0
        for x in tokens[first[t]:first[t + 1]]:
            h = (h * 0x9E3779B97F4A7C15 + int(x)) % (1 << 64)
        out[at[t]] = mix(np.array([h ^ int(counts[t])], dtype=np.uint64))[0]
    return out, at
