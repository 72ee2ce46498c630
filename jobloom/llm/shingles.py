"""Word shingles of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A word is a maximal run of bytes other than space and TAB..CR; A-Z count as a-z. A text with at least
``k`` words has its distinct k-word shingles as its set, a shorter one its whole sequence as the only
member, and a text without words (or null) the empty set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import byte_slices, text_buffers

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
STEP = [U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers_of(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for slices of the usual size, made anew for a longer text."""
    back = pow(BASE, -1, 1 << 64)
    if n >= 1 << 18:
        return _powers_of(BASE, n + 1), _powers_of(back, n + 1)
    if not _powers:
        _powers.update(up=_powers_of(BASE, 1 << 18), down=_powers_of(back, 1 << 18))
    return _powers["up"], _powers["down"]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin in that array (one more entry than texts)."""
    n = len(raw)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & ~(before & ~cut[:-1]))
    ends = np.flatnonzero(solid & ~(after & ~cut[1:])) + 1
    up, down = _power_tables(n)
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum((LOWER[raw].astype(U) + U(1)) * up[:n], out=total[1:])
    words = (total[ends] - total[starts]) * down[starts]
    words = mix(words + (ends - starts).astype(U) * STEP[0])
    return words, np.searchsorted(starts, offsets)


def shingle_hashes(raw: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in text order (with repeats), and where each text's begin."""
    words, at = word_hashes(raw, offsets)
    n_words = np.diff(at)
    n = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(bounds[-1], U)
    if len(words) >= k:
        m = len(words) - k + 1
        rolled = np.zeros(m, U)
        for j in range(k):
            rolled += words[j : j + m] * STEP[j % 5] * U(2 * (j // 5) + 1)
        long = n_words >= k
        valid = np.zeros(len(words) + 1, np.int64)
        np.add.at(valid, at[:-1][long], 1)
        np.add.at(valid, at[1:][long] - k + 1, -1)
        keep = np.cumsum(valid)[:m] > 0
        slot = np.repeat(long, n)
        out[slot] = mix(rolled[keep])
    for i in np.flatnonzero((n_words > 0) & (n_words < k)):
        w = words[at[i] : at[i + 1]]
        tail = np.array([len(w)], U) * STEP[4]
        for j in range(len(w)):
            tail += w[j : j + 1] * STEP[j]
        out[bounds[i]] = mix(tail)[0]
    return out, bounds


def shingle_sets(col: pa.Array, k: int = 5):
    """Yield the sorted distinct shingle hashes of each text of an Arrow string array."""
    raw, offsets = text_buffers(col)
    for lo, hi in byte_slices(offsets):
        all_of, bounds = shingle_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
        for i in range(hi - lo):
            s = np.sort(all_of[bounds[i] : bounds[i + 1]])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s
