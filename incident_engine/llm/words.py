"""Words, lines and shingles of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than blank and the five control blanks U+0009 to U+000D; as
these are single bytes in UTF-8, words are found on bytes. Hashes have 64 bits: sums of random byte
values times powers of an odd base (modulo 2**64), finished by a full mix, so equal byte strings have
equal hashes wherever they stand. All tables come from fixed seeds and are the same in every process.
"""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_VALUE = np.random.Generator(np.random.PCG64(1723)).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 18
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(_BLOCK + 1, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A full 64-bit mix (the splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span; `starts` must not fall. Works block by block."""
    out = np.zeros(len(starts), np.uint64)
    power, inverse = _power_tables()
    i = 0
    top = np.maximum.accumulate(ends) if len(ends) else ends
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(top, low + _BLOCK, "right")))
        s, e = starts[i:j], ends[i:j]
        high = int(e.max())
        if high - low > _BLOCK:  # one span longer than a block
            total, shift = 0, 1
            for k in range(low, high, _BLOCK):
                part = _VALUE[data[k : min(k + _BLOCK, high)]]
                total = (total + shift * int((part * power[: len(part)]).sum(dtype=np.uint64))) % 2**64
                shift = shift * int(power[_BLOCK]) % 2**64
            out[i] = total
        else:
            run = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_VALUE[data[low:high]] * power[: high - low], out=run[1:])
            out[i:j] = (run[e - low] - run[s - low]) * inverse[s - low]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def find_words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 offsets of the texts in the list of words."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = blank[data]
    edge = np.empty(len(data) + 1, bool)
    edge[1:] = space
    edge[0] = True
    edge[offsets] = True
    starts = np.flatnonzero(~space & edge[:-1])
    edge[:-1] = space
    edge[offsets] = True
    ends = np.flatnonzero(~space & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of set flags in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_of(offsets: np.ndarray) -> np.ndarray:
    """The text number of each item, given the offsets of the texts."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive word hashes, regardless of text bounds."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9DDFEA08EB382D69) + words[k : k + n]
    return mix(out)


def whole_windows(offsets: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each of n - size + 1 window starts, whether the window ends in the text it starts in."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(max(0, n - size + 1)) + size <= ends[: max(0, n - size + 1)]


def cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Flags of the items in [start, start + size) of any start, among n items."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + size, minlength=n + 1)
    return np.cumsum(change[:n]) > 0
