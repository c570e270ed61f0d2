"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts are UTF-8 bytes.  A word is a run of bytes other than space and the
control characters 9-13; A-Z count as a-z.  All functions take a list of byte
strings and return flat arrays plus the offsets of each text, so that a batch
costs a few passes over its bytes and no loop over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 2**64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.int64).astype(U64)

#: bytes handled in one go; a longer text is taken alone
SLICE_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into index ranges of about ``limit`` bytes; null counts as empty."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, dtype=U64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=U64)


def words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, offsets of each text's words, byte length of each word)."""
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    buf = np.frombuffer(joined, dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    start, stop = edge[0::2], edge[1::2]  # the last byte is a space, so every word ends
    # a sum of c * B^i over a word, divided by B^start: the same for the same word anywhere
    total = np.concatenate(([U64(0)], np.cumsum(_VALUE[_LOWER[buf]] * _powers(len(buf), _ODD), dtype=U64)))
    h = (total[stop] - total[start]) * _powers(len(buf), _INV)[start]
    length = stop - start
    h = mix(h + length.astype(U64) * U64(0xD6E8FEB86659FD93))
    offsets = np.concatenate(([0], np.searchsorted(start, ends)))
    return h, offsets, length


def shingles(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles per text: (hashes ordered by text, offsets).

    A text with fewer words than ``k`` has its whole sequence as one shingle; a
    text without words has none.
    """
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(h)) - offsets[:-1][doc]
    width = np.minimum(n, k)[doc]
    ok = pos + width <= n[doc]
    at = np.flatnonzero(ok)
    doc, width = doc[at], width[at]
    out = width.astype(U64)
    for j in range(k):
        use = width > j
        part = np.where(use, h[np.minimum(at + j, max(len(h) - 1, 0))], U64(0)) if len(h) else out
        out = mix(out * U64(_ODD) + part)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    first = np.ones(len(out), dtype=bool)
    first[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[first], doc[first]
    return out, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(n)))))


def sequence_hash(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's whole word sequence."""
    n = np.diff(offsets)
    pos = (np.arange(len(h)) - np.repeat(offsets[:-1], n)).astype(U64)
    out = []
    for salt in (0x51ED270B, 0xB492B66F):
        v = mix(h ^ mix(pos * U64(_ODD) + U64(salt)))
        total = np.concatenate(([U64(0)], np.cumsum(v, dtype=U64)))
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]] + n.astype(U64)))
    return out[0], out[1]
