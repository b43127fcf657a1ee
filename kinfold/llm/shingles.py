"""Word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (Steele et al. 2014)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts and the number of words per text.

    ``data`` holds UTF-8 bytes; white space is ASCII, so bytes are enough. A-Z count as a-z. Words are
    hashed eight bytes at a time, all words together.
    """
    first, last = (int(starts[0]), int(starts[-1] + sizes[-1])) if len(sizes) else (0, 0)
    body = data[first:last]
    upper = (body >= 65) & (body <= 90)
    low = body + (upper.view(np.uint8) << np.uint8(5))
    inside = ~((body == 32) | ((body >= 9) & (body <= 13)))
    # A text's first byte starts a word even if the text before it ends in one.
    edge = np.zeros(len(body) + 1, bool)
    edge[starts - first] = True
    edge[-1] = True
    before = np.concatenate([[False], inside[:-1]]) if len(body) else inside
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(body) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    length = end - begin
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8) if len(body) else np.zeros((0, 8), np.uint8)
    h = mix(length.astype(np.uint64) + np.uint64(BASE))
    keep = (np.uint64(MASK) >> (np.uint64(8) * (8 - np.arange(9, dtype=np.uint64)) % np.uint64(64)))
    keep[0] = 0
    going = np.arange(len(begin))
    at = begin.copy()
    while len(going):
        rest = np.minimum(end[going] - at[going], 8)
        chunk = np.ascontiguousarray(eights[at[going]]).view("<u8").ravel() & keep[rest]
        h[going] = mix((h[going] ^ chunk) * np.uint64(BASE))
        at[going] += 8
        going = going[at[going] < end[going]]
    count = np.searchsorted(begin, starts - first + sizes) - np.searchsorted(begin, starts - first)
    return h, count


def shingle_sets(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each text, and their number per text.

    A text of fewer than ``k`` words has its whole sequence as one shingle, one without words has none.
    """
    words, n_words = word_hashes(data, starts, sizes)
    first = np.cumsum(n_words) - n_words
    n_windows = np.where(n_words == 0, 0, np.maximum(n_words - k + 1, 1))
    owner = np.repeat(np.arange(len(sizes)), n_windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + first[owner]
    used = np.minimum(n_words, k)[owner]
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = mix(used.astype(np.uint64))
    for j in range(k):
        h = np.where(used > j, mix((h + padded[place + j]) * np.uint64(BASE)), h)
    ends = np.cumsum(n_windows)
    for a, b in zip((ends - n_windows).tolist(), ends.tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(sizes))
