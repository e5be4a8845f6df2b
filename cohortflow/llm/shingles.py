"""Vectorised word and shingle hashing of whole texts (numpy, inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only.  A word hash
depends on the word's bytes alone, so texts are hashed in buffers that may be
cut at any white space, and very long texts need no more memory than short
ones.
"""

from __future__ import annotations

import numpy as np

_BUFFER = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_BASE = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public splitmix constants), vectorised."""
    x = np.asarray(x, dtype=np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, _BUFFER + 1)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                steps = np.full(size, np.uint64(base), dtype=np.uint64)
                steps[0] = 1
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _buffer_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, hash) of every word in one buffer that cuts no word."""
    solid = ~_SPACE[raw]
    edge = np.diff(np.concatenate(([0], solid.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    up, down = _power_table(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_LOWER[raw] * up[: len(raw)], dtype=np.uint64)))
        value = (total[ends] - total[starts]) * down[starts]
        value += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return starts, mix(value)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words per text."""
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    at, offsets, hashes = 0, [], []
    while at < len(raw):
        end = min(at + _BUFFER, len(raw))
        while end < len(raw):  # move back to white space; a longer word extends the buffer
            space = np.flatnonzero(_SPACE[raw[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
                break
            end = min(end + _BUFFER, len(raw))
        s, h = _buffer_hashes(raw[at:end])
        offsets.append(s + at)
        hashes.append(h)
        at = end
    offsets = np.concatenate(offsets) if offsets else np.zeros(0, dtype=np.int64)
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    counts = np.diff(np.searchsorted(offsets, bounds))
    return hashes, counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct ``width``-word shingle hashes of each text.

    A text with fewer words has the whole sequence as its one shingle; a text
    without words has none.
    """
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    n = len(hashes)
    with np.errstate(over="ignore"):
        code = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            code = code * np.uint64(0xD1342543DE82EF95) + hashes[k : n - width + 1 + k] if len(code) else code
        code = mix(code + np.uint64(width))
        for c in counts.tolist():
            if c >= width:
                out.append(np.unique(code[at : at + c - width + 1]))
            elif c:
                short = np.uint64(0)
                for h in hashes[at : at + c]:
                    short = short * np.uint64(0xD1342543DE82EF95) + h
                out.append(mix(np.array([short + np.uint64(c)], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += c
    return out
