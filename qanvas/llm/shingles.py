"""Multisets of word shingles and their BagMinHash signatures, in numpy over many texts at once.

Words are those of `common.ALNUM`; a shingle is five consecutive words (all words of a shorter text). Word hashes are
differences of a prefix sum of byte values times powers of an odd base, taken back to the word's start, modulo 2^64.

BagMinHash: every shingle with weight (count) w owns independent Poisson processes over discretised weight: one of rate
1 on the level [0, 1), and one of rate 2^(j-1) on each dyadic level interval [2^(j-1), 2^j). A point of a process has a
time, a register and a level within its interval, all drawn from the shingle's hash; it counts if its level is below w.
A register keeps its smallest time. Two texts then agree on a register with probability equal to their weighted Jaccard
similarity. Points are drawn in order of time and only up to a horizon by which all registers are likely to be filled
(some m (ln m + 4) points a text, whatever its length); a text with an empty register is done again with a longer one.
"""

from __future__ import annotations

import numpy as np

from .common import ALNUM

U = np.uint64
_GOLDEN, _A, _B = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SLOT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)
#: Texts of one call: the document's number has the 16 bits above a 48-bit hash.
_MOST = 1 << 16
#: Tables of powers, kept in a worker: 16 MB, since longer pieces than `piece` bytes are rare and build their own.
_powers: list[np.ndarray] = []
_KEPT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * _A
    x = (x ^ (x >> U(27))) * _B
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    tables = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(max(n, _KEPT), b, dtype=np.uint64)
        x[0] = 1
        tables.append(np.multiply.accumulate(x))
    if n <= _KEPT:
        _powers[:] = tables
    return tables[0], tables[1]


def word_hashes(joined: bytes, piece: int = (1 << 20) - 64) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of normalised bytes that end in a space. Taken in pieces that end at a space, so
    the tables of powers and the sums stay small for very long texts (but for a single word longer than a piece)."""
    all_starts, all_hashes, at = [], [], 0
    while at < len(joined):
        stop = joined.find(b" ", min(at + piece, len(joined) - 1)) + 1
        buffer = np.frombuffer(joined, dtype=np.uint8, count=stop - at, offset=at)
        up, down = _power_tables(len(buffer) + 1)
        edges = np.flatnonzero(np.diff((buffer != 0x20).astype(np.int8), prepend=0))
        starts, ends = edges[0::2], edges[1::2]
        if len(starts):
            sums = np.cumsum(_BYTE[buffer] * up[: len(buffer)])
            before = np.where(starts > 0, sums[np.maximum(starts - 1, 0)], U(0))
            all_hashes.append(mix((sums[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64)))
            all_starts.append(starts + at)
        at = stop
    if not all_starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(all_starts), np.concatenate(all_hashes)


def shingle_runs(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, shingle hash, count) of the distinct shingles, by document and hash."""
    if len(texts) > _MOST:
        parts = [(at, shingle_runs(texts[at : at + _MOST], size)) for at in range(0, len(texts), _MOST)]
        return tuple(np.concatenate([r[i] + at if i == 0 else r[i] for at, r in parts]) for i in range(3))
    joined = b" ".join(texts).translate(ALNUM) + b" "
    starts, hashes = word_hashes(joined)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    n = np.diff(np.concatenate([[0], np.searchsorted(starts, bounds)]))
    first = np.cumsum(n) - n
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    total = np.full(len(hashes), U(size))
    for k in range(size):
        total += padded[k : k + len(hashes)] * _SLOT[k]
    doc = np.repeat(np.arange(len(texts)), n)
    keep = np.arange(len(hashes)) <= (first + n - size)[doc]
    for i in np.flatnonzero((n > 0) & (n < size)):  # the whole of a short text
        own = hashes[first[i] : first[i] + n[i]]
        total[first[i]] = (own * _SLOT[: n[i]]).sum(dtype=np.uint64) + U(n[i])
        keep[first[i]] = True
    # 48 bits of hash below the document's number: one sort of plain integers groups and orders both.
    runs = np.sort((mix(total[keep]) >> U(16)) | (doc[keep].astype(np.uint64) << U(48)))
    new = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
    counts = np.diff(np.append(new, len(runs)))
    runs = runs[new]
    return (runs >> U(48)).astype(np.int64), runs & U((1 << 48) - 1), counts


def _levels(doc: np.ndarray, shingles: np.ndarray, counts: np.ndarray):
    """The processes above weight 1: document, seed, rate, first level, weight."""
    parts, j = [], 1
    while True:
        low = 1 << (j - 1)
        at = np.flatnonzero(counts > low)
        if not len(at):
            break
        seed = mix(shingles[at] + _SLOT[j : j + 1] * U(2 * j + 1))
        parts.append((doc[at], seed, np.full(len(at), float(low)), np.full(len(at), float(low)), counts[at]))
        j += 1
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else None


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, shingles: np.ndarray, counts: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """(n_docs, m) register times; a document without shingles keeps infinities."""
    out = np.full(n_docs * m, np.inf)
    weight = np.bincount(doc, weights=counts, minlength=n_docs)
    horizon = np.divide(m * (np.log(m) + 4), weight, out=np.zeros(n_docs), where=weight > 0)
    todo = slice(None)
    while True:
        d, seeds, c = doc[todo], shingles[todo], counts[todo]
        few = weight[d] < 64
        _draw_blocks(d[few], seeds[few], None, horizon, out, m)
        _draw_steps(d[~few], seeds[~few], None, horizon, out, m)
        if (above := _levels(d, seeds, c)) is not None:
            few = weight[above[0]] < 64
            _draw_blocks(above[0][few], above[1][few], [x[few] for x in above[2:]], horizon, out, m)
            _draw_steps(above[0][~few], above[1][~few], [x[~few] for x in above[2:]], horizon, out, m)
        short = np.isinf(out.reshape(n_docs, m)).any(axis=1) & (weight > 0)
        if not short.any():
            return out.reshape(n_docs, m)
        horizon = np.where(short, horizon * 2, horizon)
        todo = np.flatnonzero(short[doc])


def _register(d: np.ndarray, bits: np.ndarray, times: np.ndarray, level, out: np.ndarray, m: int) -> None:
    if level is not None:
        rate, low, weight = level
        ok = low + np.floor(_uniform(mix(bits + _SLOT[40])) * rate) < weight
        d, bits, times = d[ok], bits[ok], times[ok]
    register = ((mix(bits + _SLOT[41]) >> U(32)) * U(m)) >> U(32)
    np.minimum.at(out, d * m + register.astype(np.int64), times)


def _draw_steps(d, seed, level, horizon, out, m) -> None:
    """A point of every process at a time; a process leaves when its time passes the horizon."""
    t, until, step = np.zeros(len(d)), horizon[d], 0
    while len(d):
        step += 1
        bits = mix(seed + U(step * int(_GOLDEN) % (1 << 64)))
        gap = -np.log(_uniform(bits))
        t = t + (gap if level is None else gap / level[0])
        go = np.flatnonzero(t < until)
        d, seed, t, until = d[go], seed[go], t[go], until[go]
        level = level and [x[go] for x in level]
        _register(d, bits[go], t, level, out, m)


def _draw_blocks(d, seed, level, horizon, out, m) -> None:
    """The same points for texts so short that each process has many: blocks of points of all processes. Sums run from
    left to right, so the times are the same ones."""
    t, step = np.zeros(len(d)), 0
    while len(d):
        block = min(512, max(16, (1 << 20) // len(d)))
        bits = mix(seed[:, None] + np.arange(step + 1, step + block + 1, dtype=np.uint64)[None] * _GOLDEN)
        gaps = -np.log(_uniform(bits))
        gaps = gaps if level is None else gaps / level[0][:, None]
        times = np.cumsum(np.concatenate([t[:, None], gaps], axis=1), axis=1)[:, 1:]
        row, col = np.nonzero(times < horizon[d][:, None])
        _register(d[row], bits[row, col], times[row, col], level and [x[row] for x in level], out, m)
        go = times[:, -1] < horizon[d]
        d, seed, t, step = d[go], seed[go], times[go, -1], step + block
        level = level and [x[go] for x in level]


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit hashes; the band's number is part of the hash."""
    x = signature[:, : bands * rows].copy().view(np.uint64).reshape(len(signature), bands, rows)
    return mix((x * _SLOT[None, None, :rows]).sum(axis=2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN).view(np.int64)


def pack_multiset(shingles: np.ndarray, counts: np.ndarray) -> bytes:
    return shingles.astype("<u8").tobytes() + counts.astype("<u4").tobytes()


def unpack_multiset(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n).astype(np.int64)


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets: sum of minima over sum of maxima."""
    (x, p), (y, q) = unpack_multiset(a), unpack_multiset(b)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[at] == x
    least = int(np.minimum(p[both], q[at[both]]).sum())
    return least / (int(p.sum()) + int(q.sum()) - least)
