"""Alignment of two tokenizers over a corpus, and how often their ids meet.

Both tokenizers cut the same bytes. Offsets at which tokens of both end cut a text into groups; an A and a B token whose bytes overlap are
linked. The count of an id pair is the number of documents that hold it linked.

1. First pass: every task aligns its documents and keeps its distinct pairs with their document counts, dealt over ``BUCKETS``.
2. Distinct pairs of a bucket come together in a tree of unions (``FAN`` tables at a time) and get a minimal perfect hash: levels of
   bit arrays, a pair is placed at the first level where it is alone; its number is the number of bits set before.
3. Every task's counts become a dense vector per bucket, indexed by that hash; vectors are summed in a tree.
   Keys are stored by number, and each lookup compares its key with the stored one.
4. Second pass: documents are aligned again and look their pairs up. The table is sent to the tasks if its size is at most
   ``TABLE_BYTES``; a larger one is joined by pair.

Texts are cut into segments that both tokenizers encode on their own (checked against the vocabulary: no piece of B crosses such a place,
and A's pattern always splits there). A segment is aligned once per worker while it is remembered; other texts (characters outside
``PLAIN``) are aligned whole.

Defined results: null and empty texts, and texts that a tokenizer doesn't give back byte for byte, have no tokens and count for nothing. Strings of
special tokens are plain text. Repeated rows are documents of their own; ids may be null or repeated, rows are told apart
by position. An empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .shingles import mix
from .transducer import byte_letters

BUCKETS = 256
FAN = 16
TABLE_BYTES = 256_000_000
GROUP_CHARS = 2_000_000
CACHED_SEGMENTS = 500_000
CACHED_TOKENS = 4_000_000
CACHED_WORDS = 250_000
DOCS_AT_ONCE = 400
SEGMENTS_AT_ONCE = 20_000
LINES_AT_ONCE = 500
PAIRS_HELD = 4_000_000
#: Free places per key and level of the hash.
GAMMA = 1.6
# Letters and other characters of plain texts, and the segments in them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[\n -~{LETTERS}«»–—‘’“”…¿¡]*").fullmatch
# How A's own pattern cuts plain segments.
WORD_A = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
SEGMENT = re.compile(rf"\s{{2,}}\S*| ?[{LETTERS}]++(?!')| ?[^\s'{LETTERS}]++(?!')| ?\S+|\s")
# End of fixed values.
MARK = "\x01"


class PerfectHash:
    """Numbers 0 to n-1 for the n keys it was built from, many buckets side by side."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], firsts: np.ndarray):
        """Per level: bits per bucket, words per bucket before, words. ``firsts``: keys of the buckets before, and all."""
        self.levels, self.firsts = [], firsts
        for sizes, offsets, words in levels:
            self.levels.append((sizes, offsets, words))
        # Keys are numbered by bucket, then level, then place.
        counts = [np.bitwise_count(w).astype(np.int64) for _, _, w in self.levels]
        base = firsts[:-1].copy()
        self.before = []
        for (_, offsets, words), c in zip(self.levels, counts):
            running = np.concatenate([[0], np.cumsum(c)])
            per_word = np.diff(np.append(offsets, len(words)))
            bucket = np.repeat(np.arange(len(offsets)), per_word)
            self.before.append(running[:-1] - running[offsets][bucket] + base[bucket] if len(words) else running[:-1])
            base += running[np.append(offsets, len(words))[1:]] - running[offsets]

    @staticmethod
    def place(keys: np.ndarray, level: int) -> np.ndarray:
        """32 hash bits per level."""
        return mix(keys.astype(np.uint64) + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> np.uint64(32)

    @staticmethod
    def bucket(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % BUCKETS

    @staticmethod
    def build(keys: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Levels ``(bits, words)`` for the distinct keys of one bucket."""
        levels = []
        while len(keys):
            n = len(keys)
            words = max(1, int(-(-n * GAMMA // 64)))
            at = (PerfectHash.place(keys, len(levels)) * np.uint64(64 * words) >> np.uint64(32)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append((64 * words, np.packbits(alone, bitorder="little").view("<u8")))
            keys = keys[~alone[at]]
        return levels

    @classmethod
    def joined(cls, buckets: list[list[tuple[int, np.ndarray]]], sizes: list[int]) -> PerfectHash:
        depth = max(map(len, buckets), default=0)
        nothing = (0, np.zeros(0, np.uint64))
        levels = []
        for i in range(depth):
            parts = [b[i] if i < len(b) else nothing for b in buckets]
            lengths = np.array([len(w) for _, w in parts])
            levels.append((np.array([m for m, _ in parts]), np.cumsum(lengths) - lengths, np.concatenate([w for _, w in parts])))
        return cls(levels, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def numbers(self, keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """-1 where the hash places a key nowhere; other unknown keys may get a number, so callers compare keys."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, ((sizes, offsets, words), before) in enumerate(zip(self.levels, self.before)):
            b = bucket[todo]
            todo, b = todo[sizes[b] > 0], b[sizes[b] > 0]
            at = (self.place(keys[todo], level) * sizes[b].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            word = offsets[b] + (at >> 6)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            hit = words[word] & bit != 0
            rank = before[word] + np.bitwise_count(words[word] & (bit - np.uint64(1)))
            out[todo[hit]] = rank[hit]
            todo = todo[~hit]
        return out


def _packed(levels: list[tuple[int, np.ndarray]]) -> bytes:
    return b"".join(np.array([len(w)], "<u8").tobytes() + w.tobytes() for _, w in levels)


def _levels(packed: bytes) -> list[tuple[int, np.ndarray]]:
    raw, out, at = np.frombuffer(packed, "<u8"), [], 0
    while at < len(raw):
        n = int(raw[at])
        out.append((64 * n, raw[at + 1 : at + 1 + n]))
        at += n + 1
    return out


class Counted:
    """Pairs by number with their counts, and whether a count is the highest of its A id."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes]], base: int):
        """``(bucket, hash, keys, counts)``, one per bucket that has pairs."""
        by_bucket = {r[0]: r for r in rows}
        parts = [by_bucket.get(b, (b, b"", b"", b"")) for b in range(BUCKETS)]
        self.keys = np.frombuffer(b"".join(r[2] for r in parts), "<i8")
        self.counts = np.frombuffer(b"".join(r[3] for r in parts), "<i8")
        self.hash = PerfectHash.joined([_levels(r[1]) for r in parts], [len(r[2]) // 8 for r in parts])
        top = np.zeros(int(self.keys.max(initial=0)) // base + 1, np.int64)
        np.maximum.at(top, self.keys // base, self.counts)
        self.best = self.counts == top[self.keys // base]
        self.name = uuid.uuid4().hex

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, whether it is the best, and whether the pair is missing (only in texts that count for nothing)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool), np.ones(len(keys), bool)
        at = self.hash.numbers(keys, PerfectHash.bucket(keys))
        missing = (at < 0) | (self.keys[at] != keys)
        return np.where(missing, 0, self.counts[at]), self.best[at] & ~missing, missing


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.all, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.all):
            larger = np.empty((self.n + len(more)) * 5 // 4, self.all.dtype)
            larger[: self.n] = self.now
            self.all = larger
        self.all[self.n : self.n + len(more)] = more
        self.n += len(more)

    @property
    def now(self) -> np.ndarray:
        return self.all[: self.n]


class Known(dict):
    """Number of each segment; asking for a new one gives it the next number and puts it on the list to be aligned."""

    def __init__(self, first: int):
        self.first, self.new = first, []

    def __missing__(self, key: str) -> int:
        self[key] = number = self.first + len(self.new)
        self.new.append(key)
        return number


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start, start + 1, ...`` of all spans, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Aligner:
    """Aligned segments of both tokenizers; what a segment brings to its document is kept by number.

    Plain texts with single spaces and line ends are cut before each of these; others by ``SEGMENT``. A segment's key is its text without
    a leading space, or the text itself if it starts with a line end, or else the text behind ``MARK``.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.model_a = self.a.model
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.letters = byte_letters()
        value = {c: b for b, c in enumerate(self.letters)}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(value[c] for c in names[i]) if all(c in value for c in names.get(i, " ")) else b"" for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i)) for i in range(len(pieces))]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() if plain[i] else b"" for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.base = len(pieces)
        self.line_b = self.b.piece_to_id("<0x0A>")
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(pieces)))]
        letter = re.compile(f"[{LETTERS}]").match

        def crosses(x: str, y: str) -> bool:
            return y == "▁" and x != y or x != "▁" and (letter(x) is None) != (letter(y) is None)

        used = [p for p, ok in zip(pieces, plain) if ok]
        self.separable = not any("\n" in p or any(crosses(x, y) for x, y in zip(p, p[1:]) if PLAIN(x + y) or "▁" in x + y) for p in used)
        self.clear()

    def clear(self) -> None:
        self.known = Known(0)
        self.words: dict[str, tuple[int, ...]] = {}
        # Per entry: tokens, groups, links, whether the bytes agree, first token and link.
        self.n_a, self.n_b, self.n_groups, self.n_links = (Grown(np.int32) for _ in range(4))
        self.good, self.at_a, self.at_b, self.at_link = Grown(bool), Grown(np.int64), Grown(np.int64), Grown(np.int64)
        # Tokens of all entries, whether a group ends after a token, and links.
        self.ids_a, self.ids_b, self.ends_a, self.ends_b = Grown(np.int32), Grown(np.int32), Grown(bool), Grown(bool)
        self.links = Grown(np.int32 if len(self.bytes_a) * self.base < 2**31 else np.int64)
        self.groups: list[str] = []
        self.counted: tuple[str, int, list[np.ndarray]] | None = None

    @property
    def n(self) -> int:
        return self.n_a.n

    def _align(self, ids_a: np.ndarray, ids_b: np.ndarray, own_a: np.ndarray, own_b: np.ndarray, n: int) -> None:
        """Append ``n`` entries: tokens of consecutive texts whose bytes agree, with the number of the text of each."""
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        start_a, start_b = end_a - self.size_a[ids_a], end_b - self.size_b[ids_b]
        at = np.searchsorted(end_b, end_a)
        cut_a = end_b[np.minimum(at, len(end_b) - 1)] == end_a if len(end_b) else np.zeros(len(end_a), bool)
        cut_b = np.zeros(len(end_b), bool)
        cut_b[at[cut_a]] = True
        first = np.searchsorted(end_b, start_a, "right")
        many = np.searchsorted(start_b, end_a, "left") - first
        keys = np.repeat(ids_a, many) * self.base + ids_b[_spans(first, many)]
        n_a, n_b, n_links = np.bincount(own_a, minlength=n), np.bincount(own_b, minlength=n), np.bincount(np.repeat(own_a, many), minlength=n)
        for total, part, size in ((self.at_a, self.ids_a, n_a), (self.at_b, self.ids_b, n_b), (self.at_link, self.links, n_links)):
            total.add(part.n + np.cumsum(size) - size)
        for column, more in (
            (self.n_a, n_a), (self.n_b, n_b), (self.n_links, n_links), (self.n_groups, np.bincount(own_a[cut_a], minlength=n)),
            (self.good, np.ones(n)), (self.ids_a, ids_a), (self.ids_b, ids_b), (self.ends_a, cut_a), (self.ends_b, cut_b), (self.links, keys),
        ):
            column.add(more)

    def _add_bad(self) -> None:
        for column in (self.n_a, self.n_b, self.n_links, self.n_groups, self.good):
            column.add(np.zeros(1))
        for total, part in ((self.at_a, self.ids_a), (self.at_b, self.ids_b), (self.at_link, self.links)):
            total.add(np.array([part.n]))

    def _word_a(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            if word.isascii() and "\n" not in word:
                # Printable ASCII stands for itself, only the space doesn't.
                shown = self.letters[32] + word[1:] if word[0] == " " else word
            else:
                shown = "".join([self.letters[b] for b in word.encode()])
            found = self.words[word] = tuple([t.id for t in self.model_a.tokenize(shown)])
        return found

    def _learn(self) -> None:
        """Align the segments that got numbers since."""
        new, self.known.new = self.known.new, []
        self.known.first += len(new)
        texts = [k if k[:1] == "\n" else k[1:] if k[:1] == MARK else " " + k for k in new]
        for i in range(0, len(texts), SEGMENTS_AT_ONCE):
            some = texts[i : i + SEGMENTS_AT_ONCE]
            # B gets the segments on lines of their own; one that starts with a line end gives it to its line.
            lead = np.array([t[0] == "\n" for t in some])
            bodies = [t[1:] if t[0] == "\n" else t for t in some]
            ids_b = [self.b.encode("\n" + "\n".join(bodies[j : j + LINES_AT_ONCE])) for j in range(0, len(bodies), LINES_AT_ONCE)]
            # B starts with the space it adds.
            ids_b = np.concatenate([np.array(x[x.index(self.line_b) :], np.int64) for x in ids_b])
            line = ids_b == self.line_b
            plain = line.sum() == len(some) and all(b and b.find(" ", 1) < 0 for b in bodies)
            if plain:
                own_b = np.cumsum(line) - 1
                stay = ~line | lead[own_b]
                ids_b, own_b = ids_b[stay], own_b[stay]
                words = [[x for w in WORD_A.findall(t) for x in self._word_a(w)] for t in some]
                sizes = np.array([len(w) for w in words])
                ids_a = np.fromiter(itertools.chain.from_iterable(words), np.int64, sizes.sum())
                raw = "".join(some).encode()
                plain = b"".join([self.bytes_a[t] for t in ids_a.tolist()]) == raw and b"".join([self.bytes_b[t] for t in ids_b.tolist()]) == raw
            if plain:
                self._align(ids_a, ids_b, np.repeat(np.arange(len(some)), sizes), own_b, len(some))
                continue
            for t in some:
                after = self.b.encode("\n" + t)
                self._one(self.a.encode(t, add_special_tokens=False).ids, after[after.index(self.line_b) + 1 :], t)
        if len(self.words) > CACHED_WORDS:
            self.words = {}

    def _one(self, ids_a: list[int], ids_b: list[int], text: str) -> None:
        """An entry for one text, a bad one where the bytes differ."""
        raw = text.encode()
        if b"".join([self.bytes_a[t] for t in ids_a]) != raw or b"".join([self.bytes_b[t] for t in ids_b]) != raw:
            self._add_bad()
            return
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        self._align(a, b, np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), 1)

    def entries(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of all texts, and how many each has; none for texts without tokens."""
        if self.n > CACHED_SEGMENTS or self.ids_a.n > CACHED_TOKENS:
            self.clear()
        get = self.known.__getitem__
        found: list[list[int] | None] = []
        for t in texts:
            if not t:
                found.append([])
            elif not (self.separable and PLAIN(t)):
                found.append(None)
            elif "  " in t or "\n " in t or " \n" in t or "\n\n" in t or t[0] in " \n" or t[-1] in " \n":
                keys = [s[1:] if s[0] == " " and s[1:2] != "\n" else s if s[0] == "\n" else MARK + s for s in SEGMENT.findall(" " + t)]
                found.append(list(map(get, keys)))
            else:
                found.append(list(map(get, t.replace("\n", " \n").split(" "))))
        self._learn()
        bad = set(np.flatnonzero(self.good.now == 0).tolist())
        for i, f in enumerate(found):
            if f is None or bad and not bad.isdisjoint(f):
                # Not plain, or not given back segment by segment.
                self._one(self.a.encode(" " + texts[i], add_special_tokens=False).ids, self.b.encode(texts[i]), " " + texts[i])
                self.known.first = self.n
                found[i] = [self.n - 1] if self.good.now[-1] else []
        sizes = np.array([len(f) for f in found], np.int64)
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, sizes.sum()), sizes

    def group_texts(self) -> list[str]:
        """Per entry its groups as text, made when first asked for."""
        done = len(self.groups)
        if done < self.n:
            p, q = int(self.at_a.now[done]), int(self.at_b.now[done])
            text_a, text_b = ([self.names[i] for i in ids.now[x:].tolist()] for ids, x in ((self.ids_a, p), (self.ids_b, q)))
            cuts = zip((np.flatnonzero(self.ends_a.now[p:]) + 1).tolist(), (np.flatnonzero(self.ends_b.now[q:]) + 1).tolist())
            parts, x, y = [], 0, 0
            for i, j in cuts:
                parts.append(f"{','.join(text_a[x:i])}|{','.join(text_b[y:j])}")
                x, y = i, j
            at = 0
            for k in self.n_groups.now[done:].tolist():
                self.groups.append(parts[at] if k == 1 else ";".join(parts[at : at + k]))
                at += k
        return self.groups

    def links_of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the entries one after the other, and how many each has."""
        sizes = self.n_links.now[entries]
        return self.links.now[_spans(self.at_link.now[entries], sizes)].astype(np.int64), sizes

    def values(self, table: Counted) -> list[np.ndarray]:
        """Per entry: sum of the counts of its links, links with the best count, links whose pair is missing."""
        name, done, found = self.counted or ("", 0, [])
        if name != table.name or done > self.n:
            done, found = 0, [np.zeros(0, np.int64)] * 3
        if done < self.n:
            keys, sizes = self.links_of(np.arange(done, self.n))
            own = np.repeat(np.arange(self.n - done), sizes)
            # Sums of integers as floats are exact below 2^53.
            new = [np.bincount(own, c, self.n - done).astype(np.int64) for c in table.of(keys)]
            found = [np.concatenate(x) for x in zip(found, new)]
        self.counted = (table.name, self.n, found)
        return found


@functools.lru_cache(1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """A Python worker runs many tasks; they share segments aligned before."""
    return Aligner(path_a, path_b)


def _grouped(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of some documents at a time."""
    for i in range(0, len(column), DOCS_AT_ONCE):
        texts, start, chars = column.slice(i, DOCS_AT_ONCE).to_pylist(), 0, 0
        for j, t in enumerate(texts):
            chars += len(t)
            if chars >= GROUP_CHARS or j == len(texts) - 1:
                yield i + start, texts[start : j + 1]
                start, chars = j + 1, 0


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted and once; sorting beats the hashing of ``np.unique`` here."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _pair_counts(aligner: Aligner, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the number of the texts that hold each."""
    entry, sizes = aligner.entries(texts)
    n, span = max(aligner.n, 1), len(aligner.bytes_a) * aligner.base
    once = _distinct(np.repeat(np.arange(len(texts)), sizes) * n + entry)
    keys, many = aligner.links_of(once % n)
    both = _distinct(np.repeat(once // n, many) * span + keys)
    keys = np.sort(both % span)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


PARTIAL = "bucket int, node long, keys binary, counts binary"


def partial_counts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """First pass: per task and bucket, distinct pairs and the number of the task's documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, node = aligner_of(path_a, path_b), TaskContext.get().partitionId()
        held_keys, held_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            bucket = PerfectHash.bucket(held_keys)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
            rows = [(b, order[x:y]) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in rows], pa.int32()), pa.array([node] * len(rows), pa.int64()),
                    pa.array([held_keys[r].tobytes() for _, r in rows], pa.binary()), pa.array([held_counts[r].tobytes() for _, r in rows], pa.binary()),
                ],
                names=["bucket", "node", "keys", "counts"],
            )

        for batch in batches:
            for _, texts in _grouped(batch.column("text")):
                some, counts = _pair_counts(aligner, texts)
                held_keys, inverse = np.unique(np.concatenate([held_keys, some]), return_inverse=True)
                held_counts = np.bincount(inverse, np.concatenate([held_counts, counts]), len(held_keys)).astype(np.int64)
                if len(held_keys) > PAIRS_HELD:
                    yield flush()
                    held_keys, held_counts = held_keys[:0], held_counts[:0]
        yield flush()

    return texts.select("text").mapInArrow(run, PARTIAL)


def _tree(rows: DataFrame, columns: str, combine: Callable[[pd.DataFrame], dict], depth: int) -> DataFrame:
    """Combine the rows of a bucket, ``FAN`` nodes at a time, to one."""

    def step(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"bucket": key[0], "node": key[1], **combine(group)}])

    for _ in range(depth):
        rows = rows.groupBy("bucket", F.floor(F.col("node") / FAN).alias("node")).applyInPandas(step, f"bucket int, node long, {columns}")
    return rows


def _join(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8")


def pair_counts(partials: DataFrame) -> DataFrame:
    """Steps 2 and 3: ``(bucket, hash, keys, counts)``, keys and counts in the order of the hash."""
    last = partials.agg(F.max("node")).first()[0] or 0
    depth = 1
    while FAN**depth <= last:
        depth += 1
    unions = _tree(partials.select("bucket", "node", "keys"), "keys binary", lambda g: {"keys": np.unique(_join(g["keys"])).tobytes()}, depth)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for bucket, raw in zip(frame["bucket"], frame["keys"]):
                keys = np.frombuffer(raw, "<i8")
                levels = PerfectHash.build(keys)
                at = PerfectHash.joined([levels], [len(keys)]).numbers(keys, np.zeros(len(keys), np.int64))
                placed = np.empty_like(keys)
                placed[at] = keys
                made.append((bucket, _packed(levels), placed.tobytes()))
            yield pd.DataFrame(made, columns=["bucket", "hash", "keys"])

    hashes = store(unions.mapInPandas(index, "bucket int, hash binary, keys binary"), "pair-hashes")

    def dense(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for bucket, node, keys, counts, packed, placed in zip(*(frame[c] for c in ("bucket", "node", "keys", "counts", "hash", "placed"))):
                keys, placed = np.frombuffer(keys, "<i8"), np.frombuffer(placed, "<i8")
                at = PerfectHash.joined([_levels(packed)], [len(placed)]).numbers(keys, np.zeros(len(keys), np.int64))
                if np.any(placed[at] != keys):
                    raise ValueError("a pair isn't in the table")
                vector = np.zeros(len(placed), np.int64)
                vector[at] = np.frombuffer(counts, "<i8")
                made.append((bucket, node, vector.tobytes()))
            yield pd.DataFrame(made, columns=["bucket", "node", "counts"])

    size = hashes.agg(F.sum(F.octet_length("hash") + F.octet_length("keys"))).first()[0] or 0
    lookup = hashes.select("bucket", "hash", F.col("keys").alias("placed"))
    met = partials.join(F.broadcast(lookup) if size <= TABLE_BYTES else lookup, "bucket")
    vectors = met.mapInPandas(dense, "bucket int, node long, counts binary")

    def total(group: pd.DataFrame) -> dict:
        out = np.frombuffer(group["counts"].iloc[0], "<i8").copy()
        for raw in group["counts"].iloc[1:]:
            out += np.frombuffer(raw, "<i8")
        return {"counts": out.tobytes()}

    sums = _tree(vectors, "counts binary", total, depth).select("bucket", "counts")
    return store(hashes.join(sums, "bucket").select("bucket", "hash", "keys", "counts"), "pair-counts")


def pair_table(counted: DataFrame, base: int) -> DataFrame:
    """``(key, a, b, documents, best)`` as rows."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, counts in zip(frame["keys"], frame["counts"]):
                yield pd.DataFrame({"key": np.frombuffer(keys, "<i8"), "documents": np.frombuffer(counts, "<i8")})

    pairs = counted.select("keys", "counts").mapInPandas(rows, "key long, documents long").withColumn("a", F.floor(F.col("key") / base))
    top = pairs.groupBy("a").agg(F.max("documents").alias("top"))
    return pairs.join(top, "a").select("key", "a", (F.col("key") % base).alias("b"), "documents", (F.col("documents") == F.col("top")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """Per document the columns of ``RESULT``; A is a byte-level tokenizer file, B a sentence-piece model."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = pair_counts(store(partial_counts(rows, path_a, path_b), "pair-partials"))
    base = aligner_of(path_a, path_b).base
    size = counted.agg(F.sum(F.octet_length("hash") + F.octet_length("keys") + F.octet_length("counts"))).first()[0] or 0
    names = [f.split(" ")[0] for f in RESULT.split(", ")]

    def numbers(aligner: Aligner, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Callable, list[str]]]:
        for x, texts in _grouped(column):
            flat, sizes = aligner.entries(texts)
            ends, groups, listed = np.cumsum(sizes), aligner.group_texts(), flat.tolist()

            def per_document(values, flat=flat, ends=ends, sizes=sizes) -> np.ndarray:
                run = np.concatenate([[0], np.cumsum(values[flat])])
                return run[ends] - run[ends - sizes]

            digests = []
            for end, k in zip(ends.tolist(), sizes.tolist()):
                text = ";".join(map(groups.__getitem__, listed[end - k : end]))
                digests.append(hashlib.sha256(text.encode()).hexdigest() if k else "")
            yield x, len(texts), flat, sizes, per_document, digests

    if size <= table_bytes:
        sent = spark.sparkContext.broadcast(Counted([tuple(r) for r in counted.collect()], base))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner, table = aligner_of(path_a, path_b), sent.value
            for batch in batches:
                for x, n, _, _, per, digests in numbers(aligner, batch.column("text")):
                    sums, best, missing = aligner.values(table)
                    if per(missing).any():
                        raise ValueError("a document's pair isn't in the table")
                    kinds = [*(c.now for c in (aligner.n_a, aligner.n_b, aligner.n_groups, aligner.n_links)), best, sums]
                    columns = [pa.array(per(k), pa.int64()) for k in kinds]
                    ids = batch.column("doc_id").slice(x, n)
                    yield pa.RecordBatch.from_arrays([ids, *columns, pa.array(digests, pa.string())], names=names)

        return rows.mapInArrow(run, RESULT)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        for batch in batches:
            for x, n, flat, sizes, per, digests in numbers(aligner, batch.column("text")):
                columns = [pa.array(per(k.now), pa.int64()) for k in (aligner.n_a, aligner.n_b, aligner.n_groups, aligner.n_links)]
                made = [np.unique(aligner.links_of(f)[0], return_counts=True) for f in np.split(flat, np.cumsum(sizes)[:-1])]
                arrays = [pa.array([m[i] for m in made], pa.list_(pa.int64())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(x, n), batch.column("doc_id").slice(x, n), *columns, pa.array(digests, pa.string()), *arrays],
                    names=["row", *[c for c in names if c not in ("n_best", "count_sum")], "keys", "times"],
                )

    told = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        links,
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>",
    )
    told = store(told, "aligned")
    each = told.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("t"))
    seen = each.join(pair_table(counted, base).select("key", "documents", "best"), "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("n_best"), F.sum(F.col("t") * F.col("documents")).alias("count_sum")
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in names]
    return told.join(seen, "row", "left").select(*filled)
