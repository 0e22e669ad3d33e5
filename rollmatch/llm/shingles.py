"""Word-shingle sets as sorted arrays of 64-bit hashes, computed for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE = 5
CHUNK = 1 << 20       # bytes of text hashed together
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WEIGHTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                     0xE7037ED1A0B428DB], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _WEIGHTS[0]
    x = (x ^ (x >> np.uint64(27))) * _WEIGHTS[1]
    return x ^ (x >> np.uint64(31))


_KNOWN: list[np.ndarray] = []  # powers of the base and of its inverse, kept by a worker from chunk to chunk


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= 2 * CHUNK and _KNOWN:
        return _KNOWN[0], _KNOWN[1]
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    one = np.ones(1, dtype=np.uint64)
    both = [np.concatenate([one, np.multiply.accumulate(np.full(max(n, 2 * CHUNK), x))]) for x in (_BASE, inverse)]
    if n <= 2 * CHUNK:
        _KNOWN[:] = both
    return both[0], both[1]


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: runs of bytes other than blank and tab to carriage return."""
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words in a buffer of bytes, and their hashes, from sums of bytes times powers of their place."""
    starts, ends = _spans(data)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(len(data))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)])])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, mixed(raw + (ends - starts).astype(np.uint64) * _WEIGHTS[4])


def _chunks(texts: Sequence[bytes]) -> Iterator[list[bytes]]:
    chunk: list[bytes] = []
    size = 0
    for text in texts:
        chunk.append(text)
        size += len(text) + 1
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def chunked_words(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Hashes of each text's words, in order, A to Z lower-cased."""
    for chunk in _chunks([(t or "").encode("utf-8", "replace").lower() for t in texts]):
        data = np.frombuffer(b"\n".join(chunk) + b"\n", dtype=np.uint8)
        starts, hashes = word_hashes(data)
        first = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(t) + 1 for t in chunk])]))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield hashes[a:b]


def sets(texts: Sequence[str | None], length: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, sorted. A to Z are lower-cased. A text of fewer words is one shingle, and one
    without words, or null, has none."""
    for chunk in _chunks([(t or "").encode("utf-8", "replace").lower() for t in texts]):
        data = np.frombuffer(b"\n".join(chunk) + b"\n", dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in chunk])])
        starts, hashes = word_hashes(data)
        first = np.searchsorted(starts, bounds)
        grams = np.zeros(max(0, len(hashes) - length + 1), dtype=np.uint64)
        for k in range(length):
            grams += mixed(hashes[k:k + len(grams)] + np.uint64(k + 1)) * _WEIGHTS[k % 5]
        grams = mixed(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= length:
                yield np.unique(grams[a:b - length + 1])
            elif b > a:
                short = np.array([b - a], dtype=np.uint64)
                for k in range(a, b):
                    short = mixed(short * _WEIGHTS[2] + hashes[k])
                yield short
            else:
                yield np.zeros(0, dtype=np.uint64)
