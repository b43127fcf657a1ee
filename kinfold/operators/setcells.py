"""Comparison of two chunks of numbered token sets inside one task (steps 2 and 3 of ``setjoin``).

Both chunks are sorted by set size. Meetings of prefix words are counted in slices of bounded size and never leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Common prefix words asked of a pair before its sets are compared, or one in ``ASKED_OF`` of those needed where that is more: unrelated long sets
#: share some by chance. Prefixes grow by as many words.
ASKED, ASKED_OF = 16, 12
#: Counters, meetings or words handled at once.
AT_ONCE = 4_000_000
#: Lists of holders from this length on are copied one by one.
LONG_LIST = 64


class Chunk(NamedTuple):
    """Sizes of the whole sets, and their shared words, rarest first, one set after the other."""

    size: np.ndarray
    length: np.ndarray
    words: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.length) - self.length


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + count - 1`` of all runs."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _slices(cost: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose costs sum up to ``most`` at the utmost, one row at least."""
    total = np.concatenate([[0], np.cumsum(cost)])
    i = 0
    while i < len(cost):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, "right")) - 1)
        yield i, j
        i = j


def _prefix(chunk: Chunk, least: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Prefix words of each set against partners of ``least`` tokens or more, and the number of them that a pair must share.

    Sets that share o tokens share k of them within the first ``size - o + k``. Unshared tokens take the first places.
    """
    partner = np.maximum(least, threshold * chunk.size)
    needed = np.ceil(threshold / (1 + threshold) * (chunk.size + partner) - 1e-9).astype(np.int64)
    asked = np.clip(needed, 1, np.maximum(ASKED, needed // ASKED_OF))
    alone = chunk.size - chunk.length
    return np.clip(chunk.size - needed + asked - alone, 0, chunk.length), asked


def _overlaps(a: Chunk, b: Chunk, x: np.ndarray, y: np.ndarray, n_words: int) -> np.ndarray:
    """Common words of the pairs ``(x, y)``, which come sorted by ``x``."""
    out = np.zeros(len(x), np.int64)
    marked = np.zeros(n_words, bool)
    a_start, b_start = a.start, b.start
    ends = np.flatnonzero(np.diff(x, append=-1)) + 1
    for i, j in zip(np.concatenate([[0], ends[:-1]]), ends):
        mine = a.words[a_start[x[i]] : a_start[x[i]] + a.length[x[i]]]
        marked[mine] = True
        lengths = b.length[y[i:j]]
        for p, q in _slices(lengths, AT_ONCE):
            hit = marked[b.words[_runs(b_start[y[i + p : i + q]], lengths[p:q])]]
            out[i + p : i + q] = np.add.reduceat(hit, np.cumsum(lengths[p:q]) - lengths[p:q], dtype=np.int64)
        marked[mine] = False
    return out


def _postings(word: np.ndarray, row: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of word, then row; start and length of each word's rows. Sorting whole numbers is much faster than a stable argsort."""
    key = word.astype(np.int64) << 32 | row
    key.sort()
    held = np.bincount(word, minlength=n_words)
    return (key & 0xFFFFFFFF).astype(np.intp), np.cumsum(held) - held, held


def similar_rows(a: Chunk, b: Chunk, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of both chunks whose sets have the similarity, and their overlaps. ``same``: a chunk with itself, each pair once."""
    if not len(a.size) or not len(b.size):
        return
    # Words that occur get numbers without gaps, by a table: sorting them would take many times the memory of the chunks.
    present = np.zeros(max((int(c.words.max()) for c in (a, b) if len(c.words)), default=0) + 1, bool)
    for c in (a, b):
        present[c.words] = True
    place = np.cumsum(present, dtype=np.int32) - 1
    n_words = int(place[-1]) + 1
    a, b = a._replace(words=place[a.words]), b._replace(words=place[b.words])
    del present, place
    a_prefix, a_asked = _prefix(a, b.size[0], threshold)
    b_prefix, b_asked = _prefix(b, a.size[0], threshold)
    # The inverted list of b's prefixes.
    row = np.repeat(np.arange(len(b.size), dtype=np.int32), b_prefix)
    holder, first, held = _postings(b.words[_runs(b.start, b_prefix)], row, n_words)
    mine = a.words[_runs(a.start, a_prefix)]
    row = np.repeat(np.arange(len(a.size), dtype=np.int32), a_prefix)
    used = held[mine] > 0
    mine, row = mine[used], row[used]
    upto = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(a.size)))])
    # Rows of b whose sizes fit.
    low = np.searchsorted(b.size, threshold * a.size - 1e-9)
    high = np.searchsorted(b.size, (a.size + 1e-9) / threshold, "right")
    cost = np.maximum(np.bincount(row, weights=held[mine], minlength=len(a.size)).astype(np.int64), len(b.size))
    none = np.zeros(0, np.intp)
    for i, j in _slices(cost, AT_ONCE):
        words = mine[upto[i] : upto[j]]
        start, n = first[words], held[words]
        # Short lists are gathered for all rows of the slice at once, long ones are copied as they stand.
        short = n < LONG_LIST
        few = holder[_runs(start[short], n[short])]
        at = np.concatenate([[0], np.cumsum(np.where(short, n, 0))])[upto[i : j + 1] - upto[i]].tolist()
        begins, ends = start[~short].tolist(), (start + n)[~short].tolist()
        many = np.concatenate([[0], np.cumsum(~short)])[upto[i : j + 1] - upto[i]].tolist()
        xs, ys = [none], [none]
        for k in range(j - i):
            x, asked = i + k, a_asked[i + k]
            lo, hi = max(low[x], x + 1) if same else low[x], high[x]
            if lo >= hi or upto[x + 1] - upto[x] < min(asked, b_asked[lo]):
                continue
            lists = [holder[p:q] for p, q in zip(begins[many[k] : many[k + 1]], ends[many[k] : many[k + 1]])]
            counts = np.bincount(np.concatenate([few[at[k] : at[k + 1]], *lists]), minlength=hi)[lo:hi]
            # What a pair must share does not fall with the size.
            y = np.flatnonzero(counts >= (asked if asked <= b_asked[lo] else np.minimum(asked, b_asked[lo:hi])))
            if len(y):
                xs.append(np.full(len(y), x))
                ys.append(y + lo)
        if same:
            # Pairs with these rows are done: their places, the first ones of each list, need not be read again.
            done = np.bincount(words, minlength=n_words)
            first, held = first + done, held - done
        x, y = np.concatenate(xs), np.concatenate(ys)
        fits = np.minimum(a.size[x], b.size[y]) >= threshold * np.maximum(a.size[x], b.size[y]) - 1e-9
        x, y = x[fits], y[fits]
        n = _overlaps(a, b, x, y, n_words)
        found = n >= (threshold - 1e-9) * (a.size[x] + b.size[y] - n)
        yield x[found], y[found], n[found]
