"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its inverse.

A merge list is proper when both halves of every merge can be built by earlier merges only. Then merges happen in the order of the list,
and text that follows can change the tokens before it only through a chain of merges, each later in the list than the one before and each
moving the border of what may still change to the left by the length of its left half. ``sufficient_lookahead`` is the longest such
chain (Berglund and van der Merwe 2023 prove that a bound exists); tokens that end that many symbols before the end of the
known text are final. A token border that is final also splits the work: what follows encodes as if it stood alone.

``LongPiece`` uses this to encode a piece of any length in constant memory: it holds at most a window and the lookahead, emits
tokens as soon as they are final and forgets them. Pieces shorter than the lookahead become final at their end; many different ones are
merged together, one round per merge of each, in numpy. A bounded memory keeps pieces seen before.
``Decoder`` turns ids back into text piece by piece, holding at most an unfinished character.

Defined results: null text counts as empty and has no tokens; a text's special tokens are found in the raw text and keep their ids; repeated
rows, null and repeated ids are encoded row by row; an empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Front, Pieces

CHUNK = 1 << 16
GROUP_CHARS = 4_000_000
WINDOW = 4096
CACHED_PIECES = 400_000
#: Pieces up to this many symbols are merged together.
SHORT = 48
NONE = np.int64(1 << 60)


@functools.cache
def byte_letters() -> list[str]:
    """Character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], size) -> int | None:
    """Symbols after a token border that settle it, or None where the list isn't proper."""
    made = {u + v: (r, u) for r, (u, v) in enumerate(merges)}
    if len(made) < len(merges) or any(made.get(t, (-1,))[0] >= r for r, uv in enumerate(merges) for t in uv):
        return None
    longest: dict[str, int] = {}
    bound = 0
    for u, v in merges:
        # The border stands where v begins; what has moved it there ended in a left spine of v.
        at, before = v, 0
        while at is not None:
            before = max(before, longest.get(at, 0))
            at = made[at][1] if at in made else None
        longest[u] = max(longest.get(u, 0), before + size(u))
        bound = max(bound, longest[u])
    return bound


class PairTable:
    """Rank and product of a pair of ids by two rounds of hashing; a pair that collides in both is in the last, sorted part."""

    BITS = 18
    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, products: np.ndarray):
        self.rank_of, self.product = ranks, products
        self.keys, self.rows = [], []
        left = np.arange(len(pairs))
        for factor in self.FACTORS:
            keys, rows = np.full(1 << self.BITS, -1, np.int64), np.zeros(1 << self.BITS, np.int32)
            slot = self._slot(pairs[left], factor)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], rows[slot[first]] = pairs[left[first]], left[first]
            self.keys.append(keys)
            self.rows.append(rows)
            left = np.delete(left, first)
        order = left[np.argsort(pairs[left])]
        self.rest, self.rest_rows = np.append(pairs[order], NONE), np.append(order, 0)

    def _slot(self, pairs: np.ndarray, factor: int) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(factor) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rows_of(self, pairs: np.ndarray) -> np.ndarray:
        """Row of each pair in the merge list, -1 where it doesn't merge."""
        out = np.full(len(pairs), -1, np.int64)
        todo = np.arange(len(pairs))
        for factor, keys, rows in zip(self.FACTORS, self.keys, self.rows):
            slot = self._slot(pairs[todo], factor)
            have = keys[slot]
            hit = have == pairs[todo]
            out[todo[hit]] = rows[slot[hit]]
            # An empty slot settles that the pair isn't listed.
            todo = todo[~hit & (have >= 0)]
        at = np.searchsorted(self.rest, pairs[todo])
        hit = self.rest[at] == pairs[todo]
        out[todo[hit]] = self.rest_rows[at[hit]]
        return out


class MergeList:
    """Vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        # Ids of a byte inside a piece and at its end.
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        ids = np.array([(vocab[u], vocab[v], vocab[u + v]) for u, v in merges], np.int64).reshape(-1, 3)
        self.base = max(vocab.values()) + 1
        self.table = PairTable(ids[:, 0] * self.base + ids[:, 1], np.arange(len(ids)), ids[:, 2])
        self.rank = dict(zip(zip(ids[:, 0].tolist(), ids[:, 1].tolist()), zip(range(len(ids)), ids[:, 2].tolist())))
        suffix = len(self.suffix)
        size = lambda t: len(t) - (suffix if suffix and t.endswith(self.suffix) else 0)
        self.lookahead = sufficient_lookahead(merges, size)
        self.size = np.zeros(self.base, np.int64)
        for token, i in vocab.items():
            self.size[i] = size(token)

    def symbols(self, piece: bytes, closed: bool) -> list[int]:
        ids = self.inner[np.frombuffer(piece, np.uint8)].tolist()
        if closed and ids:
            ids[-1] = int(self.final[piece[-1]])
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """Merges of one sequence in the order of the list, leftmost first: a heap over a linked list."""
        n = len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = []
        for i in range(n - 1):
            found = rank.get((ids[i], ids[i + 1]))
            if found:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, product = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = product, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    found = rank.get((ids[x], ids[y]))
                    if found:
                        heapq.heappush(heap, (found[0], x, ids[x], ids[y], found[1]))
        return [x for x in ids if x >= 0]

    def merge_many(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids (little-endian, 32 bits) of whole pieces, all merged together: in a round, every piece does its next merge."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        ids = self.inner[np.frombuffer(b"".join(pieces), np.uint8)]
        ends = np.cumsum(sizes)
        some = sizes > 0
        ids[ends[some] - 1] = self.final[np.frombuffer(b"".join(p[-1:] for p in pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        done_ids, done_owner = [ids[:0]], [owner[:0]]
        while len(ids):
            best = np.full(len(ids), NONE)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rows = self.table.rows_of(ids[same] * self.base + ids[same + 1])
            best[same[rows >= 0]] = rows[rows >= 0]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.repeat(np.minimum.reduceat(best, first), np.diff(np.append(first, len(ids))))
            over = least == NONE
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            hit = (best == least) & ~over
            # Of equal pairs in a row (a a a) every other one merges, from the left.
            chain = np.flatnonzero(hit[1:] & hit[:-1]) + 1
            for i in chain.tolist():
                if hit[i - 1]:
                    hit[i] = False
            ids = np.where(hit, self.table.product[np.where(hit, best, 0)], ids)
            stay = ~over
            stay[1:] &= ~hit[:-1]
            ids, owner = ids[stay], owner[stay]
        order = np.argsort(np.concatenate(done_owner), kind="stable")
        out, counts = np.concatenate(done_ids)[order].astype("<u4").tobytes(), np.bincount(np.concatenate(done_owner), minlength=len(pieces))
        at = 0
        for n in (4 * counts).tolist():
            yield out[at : at + n]
            at += n


class LongPiece:
    """A piece that arrives in parts. Holds a window and the lookahead; emits tokens once no later part can change them."""

    def __init__(self, merges: MergeList, window: int = WINDOW):
        self.merges, self.window, self.held = merges, window, b""

    def feed(self, part: bytes, last: bool) -> Iterator[list[int]]:
        look = self.merges.lookahead
        at = 0
        while at < len(part):
            take = part[at : at + self.window]
            self.held += take
            at += len(take)
            if look is not None and len(self.held) > look + 1 + self.window // 2:
                yield self._settled(look)
        if last:
            yield self.merges.merge(self.merges.symbols(self.held, True))
            self.held = b""

    def _settled(self, look: int) -> list[int]:
        # The last symbol differs at the end of a piece, so it isn't known yet.
        ids = self.merges.merge(self.merges.symbols(self.held[:-1], False))
        ends = np.cumsum(self.merges.size[ids])
        n = int(np.searchsorted(ends, len(self.held) - 1 - look, side="right"))
        if n:
            self.held = self.held[int(ends[n - 1]) :]
        return ids[:n]


class Encoder:
    """Ids of texts; pieces seen before come from a bounded memory."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.front = Front(Tokenizer.from_file(path))
        self.merges = MergeList(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def stream(self, chunks: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of one text, given in chunks; what is held doesn't grow with the text."""
        state, long = Pieces(self.front), LongPiece(self.merges)
        ahead = iter(chunks)
        chunk = next(ahead, "")
        while True:
            following = next(ahead, None)
            items = list(state.feed(chunk, following is None))
            self._learn({x for x in items if isinstance(x, str)})
            out: list[bytes] = []
            for x in items:
                if isinstance(x, str):
                    out.append(self.known[x])
                elif isinstance(x, int):
                    out.append(np.array([x], "<u4").tobytes())
                else:
                    out += [np.array(ids, "<u4").tobytes() for ids in long.feed(x[0].encode(), x[1])]
            yield np.frombuffer(b"".join(out), "<u4")
            if following is None:
                return
            chunk = following

    def texts(self, texts: list[str]) -> Iterator[Iterator[np.ndarray]]:
        """For each text its ids, in parts. Pieces of short texts are learned together."""
        at = 0
        while at < len(texts):
            held: list[list] = []
            chars = 0
            while at + len(held) < len(texts) and len(texts[at + len(held)]) <= CHUNK and chars < GROUP_CHARS:
                text = texts[at + len(held)]
                held.append(list(Pieces(self.front).feed(text, True)))
                chars += len(text)
            self._learn(set().union(*held) if held else set())
            for items in held:
                yield iter([np.frombuffer(b"".join([self._ids(x) for x in items]), "<u4")])
            at += len(held)
            if not held:
                text = texts[at]
                yield self.stream(text[i : i + CHUNK] for i in range(0, len(text), CHUNK))
                at += 1

    def _ids(self, item: str | int) -> bytes:
        return self.known[item] if isinstance(item, str) else np.array([item], "<u4").tobytes()

    def _learn(self, wanted: set) -> None:
        if len(self.known) > CACHED_PIECES:
            self.older, self.known = self.known, {}
        new = [x for x in wanted if isinstance(x, str) and x not in self.known]
        again = [x for x in new if x in self.older]
        self.known.update((x, self.older[x]) for x in again)
        new = [x for x in new if x not in self.older] if again else new
        coded = [x.encode() for x in new]
        short = [(x, c) for x, c in zip(new, coded) if len(c) <= SHORT]
        self.known.update(zip([x for x, _ in short], self.merges.merge_many([c for _, c in short])))
        for x, c in zip(new, coded):
            if len(c) > SHORT:
                long = LongPiece(self.merges)
                self.known[x] = b"".join(np.array(ids, "<u4").tobytes() for ids in long.feed(c, True))


class Decoder:
    """Ids to the text that the tokenizer's own decoder gives, as UTF-8, in parts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.bytewise = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        value = {c: b for b, c in enumerate(byte_letters())}

        def as_bytes(token: str) -> bytes:
            if self.bytewise and all(c in value for c in token):
                return bytes(value[c] for c in token)
            return token.encode()

        self.table = [as_bytes(tokens.get(i, "")) for i in range(max(tokens) + 1)]
        self.reset()

    def reset(self) -> None:
        self.started = False
        self.partial = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> bytes:
        found = map(self.table.__getitem__, ids)
        if self.bytewise:
            # Bytes of an unfinished character stay in the state.
            return self.partial.decode(b"".join(found), last).encode()
        # Without a decoder, tokens are shown one by one with a space between.
        out = (b" " if self.started and len(ids) else b"") + b" ".join(found)
        self.started = self.started or len(ids) > 0
        return out


@functools.lru_cache(2)
def coders_of(path: str) -> tuple[Encoder, Decoder]:
    """A Python worker runs many tasks; they share pieces seen before."""
    return Encoder(path), Decoder(path)


def round_trips(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode its ids again: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders_of(tokenizer)
        for batch in batches:
            counts, hashed, decoded = [], [], []
            for parts in encoder.texts(batch.column("text").to_pylist()):
                decoder.reset()
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for ids in parts:
                    n += len(ids)
                    of_ids.update(ids.tobytes())
                    of_text.update(decoder.feed(ids.tolist()))
                of_text.update(decoder.feed([], True))
                counts.append(n)
                hashed.append(of_ids.hexdigest())
                decoded.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids themselves: doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = coders_of(tokenizer)
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                ids = [np.concatenate(list(x)).astype(np.int64) for x in encoder.texts(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<long>")


def decoded(rows: DataFrame, tokenizer: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``(key, text)`` of rows of ids; null ids give empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = coders_of(tokenizer)
        for batch in batches:
            out = []
            for x in batch.column("ids").to_pylist():
                decoder.reset()
                out.append((decoder.feed(x or []) + decoder.feed([], True)).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    slim = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).cast("array<long>").alias("ids"))
    return slim.mapInArrow(run, "doc_id long, text string")
