"""Word and shingle fingerprints of many texts at once, with numpy.

A word's fingerprint is a polynomial over its bytes modulo 2^64, taken from prefix sums over the
whole buffer, then mixed; a shingle's combines its words' in order. 64 bits: a chance of about
n^2 / 2^65 that two of n different shingles fall together.
"""

from __future__ import annotations

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _R), ("down", _INV)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of ``texts`` (split at ASCII white space) and the number per text."""
    buf = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
    ends_of_text = np.cumsum([len(t or b"") + 1 for t in texts])
    inside = ~_SPACE[buf]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(buf))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * up, dtype=np.uint64)])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    last = np.searchsorted(starts, ends_of_text)
    return h, np.diff(last, prepend=0)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct fingerprints of the ``size``-word shingles of each text.

    ASCII letters are lower-cased; a text of fewer words (but not none) has its whole sequence as
    its one shingle; a null text or one without words has the empty set.
    """
    h, counts = word_hashes([t.lower() if t else t for t in texts])
    out, at = [], 0
    odd = [np.uint64((2 * i + 1) * 0xD1342543DE82EF95 % 2**64) for i in range(size)]
    if len(h) >= size:
        rolled = np.zeros(len(h) - size + 1, np.uint64)
        for i in range(size):
            rolled = mix(rolled * np.uint64(31) + h[i:len(h) - size + 1 + i] * odd[i])
    for n in counts:
        if n >= size:
            out.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for i in range(n):
                whole = mix(whole * np.uint64(31) ^ h[at + i:at + i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
