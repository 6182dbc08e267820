"""Vectorised word, phrase and window hashes of texts (numpy, used inside Spark tasks).

Words are maximal runs of bytes other than space and ``\\x09``-``\\x0D`` in the UTF-8 form
of a text; UTF-8 continuation bytes never fall in that set, so byte words and code-point
words are the same words.  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)              # odd, so it has an inverse modulo 2**64
_BASE_INV = _U(pow(int(_BASE), -1, 2 ** 64))
_SPACES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[:1] = 1
    out[1:] = base
    return np.multiply.accumulate(out, out=out)


class Words:
    """Word boundaries and 64-bit word hashes of one or more UTF-8 texts.

    ``text`` has the word hashes of all texts in order; ``first[i]:first[i + 1]`` are the
    words of text ``i``; ``begin``/``end`` are byte offsets into ``buffer``.
    """

    #: bytes hashed at a time: bounds the size of the power tables for very long texts
    BLOCK = 1 << 20
    _fwd = powers(_BASE, BLOCK + 1)
    _inv = powers(_BASE_INV, BLOCK + 1)

    def __init__(self, buffer: bytes, bounds: np.ndarray):
        """``bounds``: byte offsets where each text starts, and the end of the last.
        Each text must be followed by a space byte that belongs to it."""
        raw = np.frombuffer(buffer, np.uint8)
        space = _IS_SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        self.buffer = buffer
        self.begin, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.begin, bounds)
        self.hash = np.empty(len(self.begin), _U)
        at = 0
        while at < len(self.begin):
            lo = int(self.begin[at])
            stop = int(np.searchsorted(self.end, lo + self.BLOCK, "right"))
            if stop <= at:                       # one word longer than a block
                self.hash[at] = self._long(raw[lo:int(self.end[at])])
                at += 1
                continue
            part = raw[lo:int(self.end[stop - 1])]
            total = np.zeros(len(part) + 1, _U)
            np.cumsum(_BYTE[part] * self._fwd[:len(part)], out=total[1:])
            b, e = self.begin[at:stop] - lo, self.end[at:stop] - lo
            self.hash[at:stop] = (total[e] - total[b]) * self._inv[b]
            at = stop
        self.hash = mix(self.hash)

    @classmethod
    def _long(cls, part: np.ndarray) -> np.uint64:
        value, scale = 0, 1
        for i in range(0, len(part), cls.BLOCK):
            block = part[i:i + cls.BLOCK]
            value += int((_BYTE[block] * cls._fwd[:len(block)]).sum(dtype=_U)) * scale
            scale = scale * int(cls._fwd[cls.BLOCK]) % 2 ** 64
        return _U(value % 2 ** 64)


def words_of(texts: list[bytes]) -> Words:
    buffer = b" ".join(texts) + b" "
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return Words(buffer, np.concatenate(([0], np.cumsum(sizes))) if texts else np.zeros(1, np.int64))


def phrase_hashes(word_hash: np.ndarray, n: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (empty if there are fewer)."""
    size = len(word_hash) - n + 1
    if size <= 0:
        return np.empty(0, _U)
    out = np.zeros(size, _U)
    for j in range(n):                            # Horner's rule, n vector steps
        out *= _U(base)
        out += word_hash[j:j + size]
    return mix(out)


def window_anchors(phrase: np.ndarray, span: int) -> np.ndarray:
    """For each ``span`` consecutive phrases the index of the smallest (leftmost of ties).

    The choice depends on the phrases alone, so equal windows choose equal phrases."""
    size = len(phrase) - span + 1
    if size <= 0:
        return np.empty(0, np.int64)
    best = phrase[:size].copy()
    at = np.zeros(size, np.int16)
    for j in range(1, span):
        less = phrase[j:j + size] < best
        np.copyto(best, phrase[j:j + size], where=less)
        at[less] = j
    return np.arange(size) + at
