"""Vectorised hashing shared by the operators of this subpackage.

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR
(``[^\\x20\\x09-\\x0D]+`` over UTF-8).  Word and n-gram hashes are 64-bit:
differences of polynomial prefix sums (mod 2^64, random byte table, odd base)
passed through a finaliser, so one pass over a chunk hashes every word or
every n-gram of it without a Python loop.  Work goes in chunks of about a
megabyte, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE2 = 0xC2B2AE3D27D4EB4F | 1
_M = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) on an unsigned array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i (mod 2^64) for i < n, kept per process up to a
    chunk's length."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        have = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64),
                                                np.full(size - 1, b, np.uint64)]))
                     for b in (base, pow(base, -1, 1 << 64)))
        if size <= 4 * CHUNK:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    p, _ = powers(len(values), base)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p, out=out[1:])
    return out


def gram_hashes(values: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Hash of every run of k values (n - k + 1 of them, none if shorter)."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    h = prefix_sums(values, base)
    _, inv = powers(n, base)
    return mix((h[k:] - h[:-k]) * inv[:n - k + 1])


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _TABLE[buf]


def _words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of a byte array."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~SPACE[buf]
    d = np.diff(inside)
    starts, ends = np.flatnonzero(d == 1), np.flatnonzero(d == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    h = prefix_sums(_TABLE[buf])
    _, inv = powers(len(buf))
    return mix((h[ends] - h[starts]) * inv[starts]), starts


def _pieces(blob: bytes, limit: int) -> Iterator[bytes]:
    """Cut a long text at white space into pieces of about ``limit`` bytes."""
    i, n = 0, len(blob)
    while n - i > limit:
        j = i + limit
        while j < n and not SPACE[blob[j]]:
            j += 1
        yield blob[i:j]
        i = j
    yield blob[i:]


def word_chunks(blobs: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text's index, word hashes, offsets) for groups of whole texts:
    text ``first + j`` has the words ``offsets[j]:offsets[j + 1]``.  A text
    longer than ``limit`` comes alone."""
    i = 0
    while i < len(blobs):
        if len(blobs[i]) > limit:
            parts = [_words(np.frombuffer(p, np.uint8))[0] for p in _pieces(blobs[i], limit)]
            words = np.concatenate(parts)
            yield i, words, np.array([0, len(words)])
            i += 1
            continue
        j, size = i, 0
        while j < len(blobs) and (j == i or size + len(blobs[j]) < limit) and len(blobs[j]) <= limit:
            size += len(blobs[j]) + 1
            j += 1
        buf = np.frombuffer(b"\n".join(blobs[i:j]), np.uint8)
        words, starts = _words(buf)
        edges = np.cumsum([0] + [len(b) + 1 for b in blobs[i:j]])
        yield i, words, np.searchsorted(starts, edges)
        i = j


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (k small)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(_BASE2) + words[j:j + n]
    return mix(acc)


def sequence_hash(words: np.ndarray) -> int:
    """Hash of one whole word sequence."""
    h = len(words) * _BASE2 & _M
    for w in words.tolist():
        h = (h * _BASE2 + w) & _M
    return int(mix(np.array([h], np.uint64))[0])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by block prefix and suffix
    minima (three passes, whatever w)."""
    n = len(x)
    if n < w:
        return x[:0]
    pad = -n % w
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    head = np.minimum.accumulate(y, axis=1).ravel()
    tail = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - w + 1], head[w - 1:n])


POS = (1 << 20) - 1          # low bits of a minimiser key: the position


def window_runs(grams: np.ndarray, w: int, valid: np.ndarray):
    """Minimiser runs: for every window start p with ``valid[p]`` the
    leftmost smallest of ``grams[p:p + w]`` is its anchor; returns the
    maximal runs of consecutive starts with one anchor as
    (first start, last start, anchor).  Equal windows have equal anchors at
    equal offsets, wherever they stand.  At most 2^20 positions."""
    key = (grams & ~np.uint64(POS)) | np.arange(len(grams), dtype=np.uint64)
    m = sliding_min(key, w)
    p = np.flatnonzero(valid[:len(m)])
    if not len(p):
        e = np.zeros(0, np.int64)
        return e, e, e
    a = (m[p] & np.uint64(POS)).astype(np.int64)
    brk = np.flatnonzero((np.diff(p) != 1) | (np.diff(a) != 0))
    first = np.concatenate([[0], brk + 1])
    last = np.concatenate([brk, [len(p) - 1]])
    return p[first], p[last], a[first]
