"""64-bit hashes of words and word runs over many texts at once (numpy, bounded memory).

A word is a run of bytes other than ASCII white space. Its hash is a polynomial over random byte
values, finished by a bit mixer; it depends on the word alone. Prefix sums give all words of a buffer,
and all runs of k words, in a fixed number of array passes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

#: Bytes hashed in one go; arrays of eight bytes for each of them are held, and should fit in a core's cache.
PIECE = 1 << 16
#: Words longer than this are hashed by BLAKE2, one by one.
LONG_WORD = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U)
    out[0] = 1
    have = 1
    while have < n:
        step = U(pow(base, have, 1 << 64))
        out[have:2 * have] = out[:min(have, n - have)] * step
        have *= 2
    return out


_BYTE = 0x9E3779B97F4A7C15 | 1
_POWERS = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, ``n`` at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = _POWERS[base] = (_powers(base, size), _powers(pow(base, -1, 1 << 64), size))
    return have


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]


def _long_word(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _piece_hashes(data: np.ndarray, raw: bytes, at: int, values: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    space = SPACE[data]
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts + at, np.empty(0, U)
    up, down = powers(_BYTE, len(data) + 1)
    total = np.empty(len(data) + 1, U)
    total[0] = 0
    np.cumsum(values[data] * up[:len(data)], out=total[1:])
    out = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        word = raw[at + starts[i]:at + ends[i]]
        out[i] = _long_word(word.lower() if fold else word)  # bytes.lower changes A-Z only
    return starts + at, out


def word_hashes(raw: bytes, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word; ``fold`` takes A-Z as a-z."""
    values = FOLDED_VALUES if fold else BYTE_VALUES
    data = np.frombuffer(raw, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        if end < len(raw):
            m = _SPACE.search(raw, end)
            end = m.start() if m else len(raw)
        if end - at > 32 * PIECE:  # one word of some MB
            for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw[at:end]):
                word = m[0].lower() if fold else m[0]
                starts.append(np.array([at + m.start()]))
                hashes.append(np.array([_long_word(word)], U) if len(word) > LONG_WORD else word_hashes(m[0], fold)[1])
        else:
            s, h = _piece_hashes(data[at:end], raw, at, values, fold)
            starts.append(s)
            hashes.append(h)
        at = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, U)
    return np.concatenate(starts), np.concatenate(hashes)


def documents(texts: list[str], fold: bool = False, most: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first, bounds, hashes)`` for groups of texts of about ``most`` bytes: text ``first + i`` of the
    group has the word hashes ``hashes[bounds[i]:bounds[i + 1]]``."""
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass")
        group.append(raw)
        size += len(raw) + 1
        if size >= most or i == len(texts) - 1:
            starts, hashes = word_hashes(b"\n".join(group), fold)
            edges = np.cumsum([0] + [len(g) + 1 for g in group])
            yield first, np.searchsorted(starts, edges), hashes
            first, group, size = i + 1, [], 0


def runs(hashes: np.ndarray, k: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Hash of every run of ``k`` consecutive items (one for each start)."""
    n = len(hashes)
    if n < k:
        return np.empty(0, U)
    up, down = powers(base | 1, n + 1)
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix((total[k:] - total[:n - k + 1]) * down[:n - k + 1])
