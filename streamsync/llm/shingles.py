"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

#: Text bytes hashed at once (about 50 bytes of memory each); a longer text is cut between words.
SLICE = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(value: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; changes its argument."""
    value ^= value >> np.uint64(30)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(27)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    return value


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and hashes of the words of some bytes, A-Z taken as a-z."""
    data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begins):
        return begins, np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    value = (sums[ends] - sums[begins]) * _powers(_INVERSE, len(data))[begins]
    return begins, mixed(value ^ (ends - begins).astype(np.uint64))


def words_of(text: bytes) -> np.ndarray:
    """Hashes of a text's words, in order."""
    data, begin, found = np.frombuffer(text, np.uint8), 0, []
    while begin < len(data):
        end = begin + SLICE
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[begin:end]])
            later = gaps[-1] if len(gaps) else None
            if later is None:  # one long word: to its end
                gaps = np.flatnonzero(_SPACE[data[end:]])
                later = SLICE + gaps[0] if len(gaps) else len(data) - begin
            end = begin + int(later) + 1
        found.append(_word_hashes(data[begin:end])[1])
        begin = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted within it, and where each text's begin
    (one more entry than texts).  Fewer words than ``width`` are one shingle; none, none."""
    hashes, owner, n = [], [], 0
    while n < len(texts):
        first, size, some = n, 0, []
        while n < len(texts) and (not some or size + len(texts[n]) < SLICE) and n - first < 60_000:
            some.append(texts[n])
            size += len(texts[n]) + 1
            n += 1
        if len(some) == 1:
            words = words_of(some[0])
            counts = np.array([len(words)])
        else:
            begins, words = _word_hashes(np.frombuffer(b" ".join(some), np.uint8))
            bounds = np.cumsum([0, *(len(t) + 1 for t in some)])
            counts = np.diff(np.searchsorted(begins, bounds))
        ends = np.cumsum(counts)
        text = np.repeat(np.arange(len(some), dtype=np.uint16), counts)
        value = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for i in range(width):
            value = value * np.uint64(_BASE) + words[i : i + len(value)]
        whole = text[: len(value)] == text[width - 1 :] if len(value) else np.empty(0, bool)
        value, of = value[whole], text[: len(value)][whole]
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):  # the words of a short text are its one shingle
            one = np.zeros(len(short), np.uint64)
            for i in range(width - 1):
                have = counts[short] > i
                at = np.minimum(ends[short] - counts[short] + i, len(words) - 1)
                one = np.where(have, one * np.uint64(_BASE) + words[at], one)
            value = np.concatenate([value, one ^ counts[short].astype(np.uint64)])
            of = np.concatenate([of, short.astype(np.uint16)])
        value = mixed(value.copy())
        order = np.argsort(value)
        order = order[np.argsort(of[order], kind="stable")]
        value, of = value[order], of[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        hashes.append(value[new])
        owner.append(np.bincount(of[new], minlength=len(some)))
    sizes = np.concatenate(owner) if owner else np.empty(0, np.int64)
    every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return every, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def set_names(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set: equal sets have equal names.  0 for an empty one."""
    sizes = np.diff(bounds)
    names = np.zeros(len(sizes), np.uint64)
    some = sizes > 0
    if some.any():
        starts = bounds[:-1][some]
        total = np.add.reduceat(mixed(hashes ^ np.uint64(_BASE)), starts)
        names[some] = mixed(total + sizes[some].astype(np.uint64) * np.uint64(_INVERSE))
    return names
