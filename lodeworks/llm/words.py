"""Words of UTF-8 texts and 64-bit hashes of them, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

from lodeworks.llm.common import mix

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes whose words are hashed at once: running sums and powers take 8 bytes a byte each.
PIECE = 1 << 18

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(16, (n - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known[:n]


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any byte span follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all spans of ``size`` bytes."""
    return mix((sums[size:] - sums[:-size]) * _power(_INVERSE, len(sums))[: len(sums) - size])


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None
) -> np.ndarray:
    """A hash of each byte span; equal bytes have equal hashes, wherever they stand."""
    if sums is None:
        sums = byte_sums(data)
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts])


def words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, their hashes, and each text's first word (plus the end).

    ``inside`` tells for each byte value whether it belongs to words; a word never
    crosses from one text into the next. Words are hashed ``PIECE`` bytes at a time, by
    where they start; a longer word makes a piece of its own length.
    """
    mask = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = mask[:-1]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begin] = False
    after = np.zeros(len(data), bool)
    after[:-1] = mask[1:]
    after[begin[begin > 0] - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    first = np.searchsorted(starts, offsets)
    hashes = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + PIECE, PIECE)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            low, high = starts[a], ends[b - 1]
            hashes[a:b] = span_hashes(data[low:high], starts[a:b] - low, ends[a:b] - low)
    return starts, ends, hashes, first
