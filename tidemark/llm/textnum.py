"""Words and shingles of many texts at once as numpy arrays of 64-bit hashes.

A word is `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased. Hashes are of 64 bits: among n different words or shingles two
share one with a probability of about n*n / 2**65, 3e-8 for a million, 3 % for a thousand million. A word of up to LONG bytes is hashed as a sum of powers; in longer
ones such sums collide by construction (words of a thousand letters that swap two letters in the order of Thue and Morse do), so these are hashed by BLAKE2.
"""

from __future__ import annotations

import hashlib

import numpy as np

CHUNK = 1 << 19
WIDTH = 5
LONG = 32


_MIX = [np.uint64(k) for k in (30, 0xBF58476D1CE4E5B9, 27, 0x94D049BB133111EB, 31)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which each bit depends on all."""
    x = x ^ (x >> _MIX[0])
    x *= _MIX[1]
    x ^= x >> _MIX[2]
    x *= _MIX[3]
    x ^= x >> _MIX[4]
    return x


def series(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = series(256, 11)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_COEF = series(64, 23) | np.uint64(1)
_BASE = 0x2545F4914F6CDD1D
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _up_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 4096)
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers


def digest(raw: bytes) -> int:
    """64 bits of a real hash, for what is too long for a sum of powers."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _piece(a: np.ndarray, space: np.ndarray = _SPACE, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    ink = ~space[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], ink, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, np.zeros(0, np.uint64), *(np.zeros(0, np.uint64) for _ in heads)
    up, down = _up_to(len(a) + 1)
    total = np.empty(len(a) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[a] * up[: len(a)], out=total[1:])
    out = [mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))]
    for k in np.flatnonzero(end - start > LONG).tolist():
        out[0][k] = digest(a[start[k] : end[k]].tobytes().translate(_LOW))
    for n in heads:
        long = start[end - start > n]
        out.append(mix((total[long + n] - total[long]) * down[long] + np.uint64(n + 1_000_000)))
    return start, end, *out


def words(raw: bytes, space: np.ndarray = _SPACE, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Byte starts, byte ends and hashes of the words; worked off in pieces of about 1 MB, however long the text is.

    space: which bytes part words. heads: for each n of these follow the hashes of the first n bytes of the longer words."""
    a = np.frombuffer(raw, np.uint8)
    if len(a) <= CHUNK:
        return _piece(a, space, heads)
    found, at = [], 0
    while at < len(a):
        to = min(at + CHUNK, len(a))
        while to < len(a) and not space[a[to]]:
            to += 1
        s, e, *h = _piece(a[at:to], space, heads)
        found.append((s + at, e + at, *h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` words."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    n = len(h) - width + 1
    out = h[:n] * _COEF[0]
    for k in range(1, width):
        out = out + h[k : k + n] * _COEF[k]
    return mix(out)


def shingle_list(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the runs of `width` words; of fewer words, the whole sequence as one; none without words."""
    if len(h) >= width or not len(h):
        return runs(h, width)
    return mix((h * _COEF[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))


def shingle_set(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingle_list(h, width))


def encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def batches(texts, size: int = CHUNK):
    """Yields lists of (row number, utf-8 text) of about `size` bytes."""
    held, n = [], 0
    for i, t in enumerate(texts):
        held.append((i, encode(t)))
        n += len(held[-1][1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def words_of(texts):
    """Row number, byte starts, byte ends and word hashes of each text; short texts share one pass over a buffer."""
    for held in batches(texts):
        if len(held) == 1:
            yield held[0][0], *words(held[0][1])
            continue
        at = np.cumsum([0, *(len(r) + 1 for _, r in held)])
        s, e, h = words(b" ".join([*(r for _, r in held), b""]))
        to = np.searchsorted(s, at)
        for k, (i, _) in enumerate(held):
            a, b = to[k], to[k + 1]
            yield i, s[a:b] - at[k], e[a:b] - at[k], h[a:b]


def jaccard_reaches(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b| for sorted sets; a length filter and a suffix filter on value ranges come first.

    The suffix filter splits the value range at 15 fixed pivots: what both sets can share is at most the sum, over the
    ranges, of the smaller count."""
    x, y = len(a), len(b)
    if not x or not y or 100 * min(x, y) < percent * max(x, y):
        return False
    least = -(-percent * (x + y) // (100 + percent))
    pivots = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
    ca, cb = (np.diff(np.concatenate(([0], np.searchsorted(v, pivots), [len(v)]))) for v in (a, b))
    if np.minimum(ca, cb).sum() < least:
        return False
    at = np.searchsorted(b, a)
    at[at == y] = y - 1
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (x + y - both)
