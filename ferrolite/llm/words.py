"""Words and word shingles of whole batches of texts as 64-bit hashes, in numpy.

A batch's UTF-8 bytes are handled as one array: lower-casing, word bounds and the polynomial hash of every
word take a fixed number of array operations, however many texts there are. What needs numbers of eight bytes for each
byte goes in passes of ``PASS`` bytes, within a text as well, so a text of 100 MB takes some bytes of memory for each byte. White space is ASCII
(0x20, 0x09-0x0D), so no multi-byte character is ever split.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Bytes that are hashed at once.
PASS = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_Q = [np.uint64(pow(0xD1342543DE82EF95, k, 2**64)) for k in range(SHINGLE_WORDS)]
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse, grown as needed and kept."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (_P, _P_INV):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _powers = (both[0], both[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a batch: byte bounds and hashes, and for each text the bounds of its words."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a null-free string array and the offsets of its texts in them."""
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``; no run crosses from one text to the next."""
    n = len(buf)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    return (np.flatnonzero(begin), np.flatnonzero(end) + 1) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run [start, end); the runs are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + PASS, side="right"))
        if to == at:  # a run longer than a pass
            to = at + 1
            out[at] = _sum_of(buf[starts[at] : ends[at]])
        else:
            low, high = int(starts[at]), int(ends[to - 1])
            part = buf[low:high]
            up, down = powers(PASS + 1)
            total = np.empty(len(part) + 1, np.uint64)
            total[0] = 0
            np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
            out[at:to] = (total[ends[at:to] - low] - total[starts[at:to] - low]) * down[starts[at:to] - low]
        at = to
    out += (ends - starts).astype(np.uint64)
    return mix(out)


def _sum_of(run: np.ndarray) -> np.uint64:
    """The polynomial of one long run, pass by pass."""
    up, total = powers(PASS + 1)[0], 0
    for at in range(0, len(run), PASS):
        part = run[at : at + PASS]
        total += int((_BYTE[part] * up[: len(part)]).sum()) * pow(int(_P), at, 2**64)
    return np.uint64(total % 2**64)


def words(texts: pa.Array) -> Words:
    """Lower-case A-Z; a word is a run of bytes other than 0x20 and 0x09-0x0D."""
    buf, offsets = raw(texts)
    buf = LOWER[buf]
    starts, ends = spans(buf, offsets, ~IS_SPACE[buf])
    return Words(buf, starts, ends, run_hashes(buf, starts, ends), np.searchsorted(starts, offsets), offsets)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each window of ``width`` consecutive hashes (as many windows as hashes less width - 1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    q, out = np.uint64(0xD1342543DE82EF95), hashes[:n].copy()
    for k in range(1, width):
        out *= q
        out += hashes[k : k + n]
    return mix(out)


def short_hash(hashes: np.ndarray) -> np.uint64:
    """Of a whole sequence of fewer words than a shingle has; its length takes part."""
    out = 0x5851F42D4C957F2D + len(hashes)
    for h in hashes.tolist():
        out = (out * 0xD1342543DE82EF95 + h) & (2**64 - 1)
    return mix(np.array([out], dtype=np.uint64))[0]


def shingles(w: Words, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text the hashes of its shingles, repeats included.

    A text with fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    every = windows(w.hashes, width)
    out = []
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(every[a : b - width + 1])
        elif b > a:
            out.append(np.array([short_hash(w.hashes[a:b])], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
