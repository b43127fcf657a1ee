"""Token ids in binary files with Simple-8b packing.

A segment holds documents of one shard in order: a header, document ids and lengths, the word offset of
every block of 1,024 ids, 64-bit words, and exceptions. A word has a 4-bit selector and 60 bits of ids:

    selector   1  2  3  4  5  6  7  8  9 10 11 12 13 14 15
    ids      120 60 30 20 15 12 10  8  7  6  5  4  3  2  1
    bits       0  1  2  3  4  5  6  7  8 10 12 15 20 30 60

Selector 0 is an escape: the id needs more than 60 bits, the payload is its place among the exceptions.
Blocks start on a word, so blocks are packed and unpacked side by side.

Documents are sorted by id over all shards (range partitions), nulls first, then by text. Spark's text
writer writes a segment per row (a line feed follows each, lengths tell where it ends), so shards go to any
file system under Spark's commit protocol. Readers get a shard's first position from the totals of the shards before it.

Defined results: null text is encoded as empty and yields the end id only; repeated rows are all written; a
text longer than a segment makes one segment of its own; an empty table gives files without segments.
Columns other than id and text aren't read.
"""

from __future__ import annotations

import functools
import gc
import re
import struct
import threading
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, store
from .pieces import CUT, PLAIN
from .transducer import byte_letters

BLOCK = 1024
SEGMENT_IDS = 1_000_000
SHARD_BYTES = 16_000_000
END_ID = 2
CACHED_WORDS = 350_000
CACHED_PIECES = 150_000
# Seconds without a task after which a worker lets its encoder go; Spark keeps idle workers for a minute.
IDLE_SECONDS = 5
TEXTS_AT_ONCE = 1_000
MAGIC = b"S8B1"
HEADER = struct.Struct("<4sIQQQQ")
# Ids and bits per selector of Simple-8b; selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
# End of fixed values.
PAD = int(COUNTS.max())
POWERS = 2 ** np.arange(64, dtype=np.uint64)
SMALL_BITS = np.searchsorted(POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, word offset of each block, exceptions."""
    ids = np.asarray(ids, np.uint64)
    n_blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((n_blocks, BLOCK + PAD), np.uint64)
    flat = np.zeros(n_blocks * BLOCK, np.uint64)
    flat[: len(ids)] = ids
    grid[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    lengths = np.full(n_blocks, BLOCK)
    if n_blocks:
        lengths[-1] = len(ids) - (n_blocks - 1) * BLOCK
    bits = SMALL_BITS[np.minimum(grid, len(SMALL_BITS) - 1).astype(np.int32)]
    large = np.nonzero(grid >= len(SMALL_BITS))
    bits[large] = np.searchsorted(POWERS, grid[large], side="right")
    # Per position the selector with most ids whose bits suffice; windows widen step by step.
    choice = np.zeros((n_blocks, BLOCK), np.uint8)
    widest, width = bits, 1
    for s in range(15, 0, -1):
        while width < COUNTS[s]:
            step = min(width, int(COUNTS[s]) - width)
            ahead = np.zeros_like(widest)
            ahead[:, :-step] = widest[:, step:]
            widest, width = np.maximum(widest, ahead), width + step
        choice[widest[:, :BLOCK] <= BITS[s]] = s
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    rows = np.arange(n_blocks)
    at = np.zeros(n_blocks, np.int64)
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    n_words = np.zeros(n_blocks, np.int64)
    while len(rows):
        taken.append((rows, at))
        n_words[rows] += 1
        at = at + COUNTS[choice[rows, at]]
        going = at < lengths[rows]
        rows, at = rows[going], at[going]
    # The word of step i of a block is the i-th of that block.
    offsets = np.cumsum(n_words) - n_words
    row, pos = np.empty(n_words.sum(), np.int64), np.empty(n_words.sum(), np.int64)
    for i, (rows, at) in enumerate(taken):
        row[offsets[rows] + i], pos[offsets[rows] + i] = rows, at
    selector = choice[row, pos]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        own = np.flatnonzero(selector == s)
        for k in range(COUNTS[s] if len(own) else 0):
            words[own] |= grid[row[own], pos[own] + k] << np.uint64(k * BITS[s])
    escaped = np.flatnonzero(selector == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    return words, offsets.astype(np.uint32), grid[row[escaped], pos[escaped]]


def unpack(words: np.ndarray, offsets: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    n_blocks = len(offsets)
    grid = np.zeros((n_blocks, BLOCK + PAD), np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    row = np.repeat(np.arange(n_blocks), np.diff(np.append(offsets, len(words)).astype(np.int64)))
    before = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    pos = before - before[offsets.astype(np.int64)][row] if n_blocks else before
    for s in range(2, 16):
        own = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s] if len(own) else 0):
            grid[row[own], pos[own] + k] = (words[own] >> np.uint64(k * BITS[s])) & mask
    escaped = np.flatnonzero(selector == 0)
    grid[row[escaped], pos[escaped]] = exceptions[(words[escaped] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return grid[:, :BLOCK].ravel()[:n]


def segment(shard: int, number: int, doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    words, offsets, exceptions = pack(ids)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    return b"".join(
        [
            HEADER.pack(MAGIC, len(doc_ids), shard, number, len(words), len(exceptions)),
            np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
            known.tobytes(),
            np.array(lengths, "<u8").tobytes(),
            offsets.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            exceptions.astype("<u8").tobytes(),
        ]
    )


def segments(content: bytes) -> Iterator[tuple[int, int, list, np.ndarray, np.ndarray]]:
    """Shard, number, document ids, lengths and token ids of each segment of a file."""
    at = 0
    while at < len(content):
        magic, n_docs, shard, number, n_words, n_exceptions = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, kind, n, at)
            at += out.nbytes
            return out

        doc_ids, known, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
        n = int(lengths.sum())
        offsets = take("<u4", -(-n // BLOCK))
        words, exceptions = take("<u8", n_words), take("<u8", n_exceptions)
        yield shard, number, [int(d) if k else None for d, k in zip(doc_ids, known)], lengths.astype(np.int64), unpack(words, offsets, exceptions, n)
        at += 1


class Remembered(dict):
    """Values made when first asked for. When too many are held, those in use come back from the older half, the others go with it."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        self[key] = found = self.make(key) if found is None else found
        return found

    def age(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts. The tokenizer splits at white space first, so each different word is encoded once and texts are put
    together. New plain words are cut as the tokenizer cuts them, and each different piece goes to its model once; other words go through all its
    steps. Texts that hold a special token are encoded whole."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.mark = next(((t.content, i) for i, t in added.items() if t.special), None)
        self.split = re.compile(r"[^ \t-\r]+").findall
        self.words = Remembered(self._word, CACHED_WORDS)
        self.pieces = Remembered(self._piece, CACHED_PIECES)
        self.letters = byte_letters()
        self.model = self.tokenizer.model

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        word = self.words.__getitem__
        for text in texts:
            if any(s in text for s in self.special):
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            if PLAIN(text):
                # No other white space than ASCII's, so the faster split agrees.
                words = text.split()
            else:
                words = self.split(text)
                self._learn(list({w for w in words if w not in self.words and not PLAIN(w)}))
            yield np.frombuffer(b"".join(map(word, words)), np.uint32)
            self.words.age()
            self.pieces.age()

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, CUT.findall(word.lower())))

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])

    def _learn(self, words: list[str]) -> None:
        """Encode words in one text, held apart by a special token, of which they are free."""
        if not words:
            return
        if self.mark is None:
            found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            self.words.update((w, np.array(x, np.uint32).tobytes()) for w, x in zip(words, found))
            return
        [found] = self.tokenizer.encode_batch_fast([f" {self.mark[0]} ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        ends = np.append(np.flatnonzero(ids == self.mark[1]), len(ids))
        packed, start = ids.tobytes(), 0
        for w, end in zip(words, (4 * ends).tolist()):
            self.words[w] = packed[start:end]
            start = end + 4


@functools.lru_cache(1)
def encoder_of(path: str) -> WordEncoder:
    """A Python worker runs many tasks; they share what it has encoded."""
    return WordEncoder(path)


def _let_go() -> None:
    """A task that has the encoder at this time keeps it; the next one makes a new one."""
    encoder_of.cache_clear()
    # Encoder and caches refer to each other.
    gc.collect()


_leave: threading.Timer | None = None


@contextmanager
def lent_encoder(path: str) -> Iterator[WordEncoder]:
    """The worker's encoder. Its caches would stand beside the memory of the stages that follow, so it goes when no task asks for it."""
    global _leave
    if _leave is not None:
        _leave.cancel()
    try:
        yield encoder_of(path)
    finally:
        _leave = threading.Timer(IDLE_SECONDS, _let_go)
        _leave.daemon = True
        _leave.start()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode, append ``end_id`` to each document and write shards in id order under ``path``."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    tie = F.xxhash64("text")
    ranged = slim.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), tie)
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, lengths, parts, held, number = [], [], [], 0, 0
        shard = 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, parts, held, number
            out = pa.array([segment(shard, number, doc_ids, lengths, np.concatenate(parts))], pa.binary())
            doc_ids, lengths, parts, held, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([out], names=["value"])

        with lent_encoder(tokenizer) as encoder:
            for batch in batches:
                # A batch has up to 10,000 texts; few of them are held as Python strings at a time.
                for i in range(0, len(batch), TEXTS_AT_ONCE):
                    some = batch.slice(i, TEXTS_AT_ONCE)
                    shard = some.column("shard")[0].as_py()
                    for d, ids in zip(some.column("doc_id").to_pylist(), encoder(some.column("text").to_pylist())):
                        doc_ids.append(d)
                        lengths.append(len(ids) + 1)
                        parts += [ids, np.array([end_id], np.uint32)]
                        held += len(ids) + 1
                        if held >= SEGMENT_IDS:
                            yield flush()
        if doc_ids:
            yield flush()

    tagged = ordered.select("doc_id", "text", F.spark_partition_id().alias("shard"))
    tagged.mapInArrow(encode, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document: shard, place, doc_id, start, n_tokens, ids_crc32 and, if wanted, the ids."""
    columns = "shard long, segment long, place long, doc_id long, within long, n_tokens long, ids_crc32 long" + (
        ", ids array<long>" if with_ids else ""
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for shard, number, doc_ids, lengths, ids in segments(bytes(content)):
                    ends = np.cumsum(lengths)
                    cut = [ids[e - n : e] for e, n in zip(ends, lengths)]
                    out = {
                        "shard": shard, "segment": number, "place": np.arange(len(lengths)), "doc_id": pd.array(doc_ids, "Int64"),
                        "within": ends - lengths, "n_tokens": lengths, "ids_crc32": [zlib.crc32(x.astype("<u4")) for x in cut],
                    }
                    if with_ids:
                        out["ids"] = [x.astype(np.int64) for x in cut]
                    yield pd.DataFrame(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    rows = files.mapInPandas(decode, columns)
    # Documents are placed by the totals of the segments before theirs: one row per segment, about a million ids.
    kept = rows if with_ids else store(rows, "token-rows")
    sums = kept.groupBy("shard", "segment").agg(F.sum("n_tokens").alias("n"))
    per_shard = sums.groupBy("shard").agg(F.sum("n").alias("shard_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    first = per_shard.select("shard", F.coalesce(F.sum("shard_n").over(before), F.lit(0)).alias("shard_start"))
    placed = sums.select("shard", "segment", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("seg_start")).join(first, "shard")
    start = (F.col("shard_start") + F.col("seg_start") + F.col("within")).alias("start")
    extra = ["ids"] if with_ids else []
    return kept.join(placed, ["shard", "segment"]).select("doc_id", start, "n_tokens", "ids_crc32", "shard", "segment", "place", *extra)


def token_file_digests(docs: DataFrame, tokenizer: str, path: str | None = None, **columns) -> DataFrame:
    """Write, read back, and return one row per document without the ids."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **columns)
    return read_tokens(docs.sparkSession, path, with_ids=False)
