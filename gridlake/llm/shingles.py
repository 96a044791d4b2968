"""Word shingles of whole texts as 64-bit hashes, computed on Arrow buffers with numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
_M1, _M2, _GOLD = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
_MULT = U(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    code = np.arange(256, dtype=U)
    code[65:91] += U(32)  # A-Z in lower case
    return space, mix((code + U(1)) * _GOLD)


_SPACE, _CODE = _tables()


def word_spans(buf: np.ndarray, offs: np.ndarray, space: np.ndarray = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all words, and the first word of each document (with the total at the end).

    ``space`` marks the bytes that stand between words (default: ASCII white space).
    """
    solid = ~(_SPACE if space is None else space)[buf]
    n = len(buf)
    begins, ends = solid.copy(), solid.copy()
    if n:
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        cut = offs[:-1][offs[:-1] < offs[1:]]
        begins[cut] = solid[cut]
        last = offs[1:][offs[:-1] < offs[1:]] - 1
        ends[last] = solid[last]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begins, ends, np.searchsorted(begins, offs)


def word_hashes(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word: a polynomial of its byte codes, by differences of a running sum, then mixed."""
    if len(begins) == 0:
        return np.zeros(0, U)
    n = len(buf)
    power = np.full(n, _MULT, U)
    power[0] = U(1)
    power = np.multiply.accumulate(power)
    run = np.zeros(n + 1, U)
    np.cumsum(_CODE[buf] * power, out=run[1:])
    inverse = np.full(n, U(pow(int(_MULT), -1, 1 << 64)), U)
    inverse[0] = U(1)
    inverse = np.multiply.accumulate(inverse)
    return mix((run[ends] - run[begins]) * inverse[begins] + (ends - begins).astype(U) * _GOLD)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, sorted, and the first of each (with the total at the end).

    A document with fewer than ``width`` words has its whole sequence as one shingle; without words, none.
    """
    begins, ends, first = word_spans(buf, offs)
    w = word_hashes(buf, begins, ends)
    count = np.diff(first)
    docs = len(count)
    sizes = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    start = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(start[-1], U)
    if len(w):
        factor = [mix(np.array([7919 + 31 * k], U))[0] | U(1) for k in range(width)]
        win = np.full(max(len(w) - width + 1, 0), U(width), U)
        for k in range(width):
            win += w[k : k + len(win)] * factor[k]
        win = mix(win)
        for d in range(docs):
            a, b = start[d], start[d + 1]
            if count[d] >= width:
                out[a:b] = win[first[d] : first[d] + sizes[d]]
                out[a:b].sort()
            elif count[d]:
                h = U(count[d])
                part = w[first[d] : first[d + 1]]
                out[a] = mix(np.array([h + (part * np.array(factor[: count[d]], U)).sum(dtype=U)], U))[0]
    keep = np.ones(len(out), bool)
    if len(out):
        keep[1:] = out[1:] != out[:-1]
        keep[start[:-1][sizes > 0]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], total[start]
