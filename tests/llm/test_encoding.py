"""Transducer, Merkle manifest and tokenizer alignment against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinfold.llm import alignment, merkle, pieces, transducer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS, BYTES, PIECES = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [
    "'", "s", "re", "ll", " ", "  ", "a", "é", "é", "́", "1", "²", "!", "<|endoftext|>", "<|end", "<s>", "Σ", "İ", "ß", "\n", "\n\n", "\xa0",
    "中", "하", "ᆫ", "the", "ing", "𝐀", "Ⅷ", "\x1c", "'ve", "'V", "don't", "Ɤ", "ſ", ";", "\r", "{\r", "\t", "▁", ".", "_", "(", ")\n", "«", "’", "\x00",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(1200)]
    plain = [p for p in PARTS if alignment.PLAIN(p)]
    made += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    made += [None, "", " ", "\n", "the same text. ", "the same text. ", "x" * 9000, ("word " * 30_000) + "end"]
    return made


@pytest.fixture(scope="module")
def rows(texts):
    rng = random.Random(2)
    langs = [None, "en", "de", "É", "é", ""]
    made = [(i, t, rng.choice(langs), rng.choice([None, "a", "b"]), rng.choice([None, i])) for i, t in enumerate(texts)]
    return made + [(None, "no id", "en", None, 1), (None, "no id", "en", None, 1), (5, "again", "en", "a", 2), (5, "again", "en", "a", 2), (7, "x", None, "a", 2**63 - 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    # Columns that operators might use themselves.
    for name in ("ids", "g", "n", "rank", "node", "tie", "leaf", "row", "keys", "bucket", "n_tokens", "held"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


# -- transducer --------------------------------------------------------------------------


def test_round_trips(docs, rows, empty):
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = transducer.round_trips(docs, WORDS)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert same(got.collect(), want)
    assert transducer.round_trips(empty, WORDS).count() == 0


def test_ids_and_texts(docs, rows):
    library = Tokenizer.from_file(WORDS)
    some = docs.filter("doc_id < 50")
    ids = transducer.encoded(some, WORDS)
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, *_ in rows if i is not None and i < 50 and t != "again" and t != "x"}
    got = [(r["doc_id"], r["ids"]) for r in ids.collect()]
    assert all(x == want[i] for i, x in got if i in want and i not in (5, 7))
    back = {r["doc_id"]: r["text"] for r in transducer.decoded(ids, WORDS).collect()}
    assert all(back[i] == library.decode(x, skip_special_tokens=False) for i, x in want.items() if i not in (5, 7))


@pytest.mark.parametrize("chunk", [1, 2, 3, 1000, 4097, 1 << 16])
def test_stream_in_chunks_of_any_size(texts, chunk):
    library, encoder = Tokenizer.from_file(WORDS), transducer.Encoder(WORDS)
    rng = random.Random(3)
    long = ["".join(rng.choice("thetioningres") for _ in range(20_000)), "a" * 12_000, "!'" * 5_000 + "s", "é" * 6_000, "th" * 3 + "é" * 5_000 + "x 1"]
    for text in (texts[:400] if chunk < 1000 else long):
        parts = list(encoder.stream((text or "")[i : i + chunk] for i in range(0, len(text or ""), chunk)))
        assert np.concatenate(parts).tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_a_long_piece_is_forgotten_as_it_is_read():
    merges = transducer.MergeList(WORDS)
    piece, rng = transducer.LongPiece(merges, 512), random.Random(5)
    out = []
    for _ in range(200):
        out += list(piece.feed("".join(rng.choice("theringoas") for _ in range(700)).encode(), False))
        assert len(piece.held) <= 2 * 512 + merges.lookahead + 1
    assert sum(map(len, out)) > 10_000


def test_lookahead_settles_tokens():
    rng = random.Random(6)
    for _ in range(40):
        # A proper list: both halves are letters or made before.
        known, merges = list("abc"), []
        for _ in range(12):
            u, v = rng.choice(known), rng.choice(known)
            if u + v not in known and len(u + v) < 9:
                merges.append((u, v))
                known.append(u + v)
        look = transducer.sufficient_lookahead(merges, len)
        assert look is not None and look <= sum(len(u) for u, _ in merges)
        ids = {t: i for i, t in enumerate(known)}
        table = object.__new__(transducer.MergeList)
        table.rank = {(ids[u], ids[v]): (r, ids[u + v]) for r, (u, v) in enumerate(merges)}
        for _ in range(60):
            start = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
            whole = start + "".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))
            a, b = ([known[i] for i in table.merge([ids[c] for c in s])] for s in (start, whole))
            at = 0
            for x, y in zip(a, b):
                at += len(x)
                if at > len(start) - look:
                    break
                assert x == y
    assert transducer.sufficient_lookahead([("ab", "c"), ("a", "b")], len) is None


def test_merging_together_equals_merging_alone():
    merges, rng = transducer.MergeList(WORDS), random.Random(7)
    words = ["".join(rng.choice("aaathéing1") for _ in range(rng.randint(1, 14))).encode() for _ in range(500)]
    for word, found in zip(words, merges.merge_many(words)):
        assert np.frombuffer(found, "<u4").tolist() == merges.merge(merges.symbols(word, True))


def test_bytes_come_back_as_text_piece_by_piece():
    library, decoder = Tokenizer.from_file(BYTES), transducer.Decoder(BYTES)
    ids = library.encode("Zoë 中文 𝐀 ok<|endoftext|>", add_special_tokens=False).ids
    broken = ids[:3] + [library.token_to_id("Ã")] + ids[3:]
    for sequence in (ids, broken, [library.token_to_id("Ã")]):
        decoder.reset()
        out = b"".join(decoder.feed([i]) for i in sequence) + decoder.feed([], True)
        assert out.decode() == library.decode(sequence, skip_special_tokens=False)


def test_plain_characters_are_cut_as_the_tokenizer_cuts():
    library = Tokenizer.from_file(WORDS)
    front = pieces.Front(library)
    for text in ("Aé!'s 12ß_'veÿ\n-Ⱥ x'll", "".join(chr(c) for c in range(1, 0x250) if pieces.PLAIN(chr(c)))):
        normal = library.normalizer.normalize_str(text)
        spans = [normal[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(normal)]
        assert pieces.CUT.findall(front.normalise(text)) == spans


# -- Merkle manifest ---------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r, more=0):
        i, text, lang, source, n = r
        fields = (i, source, lang, None if n is None else n + more, text)
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])

    def tree(nodes):
        paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            up, held = [], []
            for i in range(0, len(nodes), 2):
                run = nodes[i : i + 2]
                for j in range(len(run)):
                    for k in below[i + j]:
                        paths[k].append((2, None) if len(run) == 1 else (j, run[1 - j]))
                up.append(sha(*run))
                held.append(sum(below[i : i + 2], []))
            nodes, below = up, held
        return nodes[0], paths

    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    trees = []
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        ordered = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((ordered, *tree([leaf(r) for r in ordered])))
    root, tops = tree([t[1] for t in trees])
    out = []
    for (ordered, subroot, paths), top in zip(trees, tops):
        for r, path in zip(ordered, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, int(hit))
            for side, other in path + top:
                h = sha(h) if side == 2 else sha(h, other) if side == 0 else sha(other, h)
            proof = sha(*[o for s, o in path + top if s != 2])
            out.append((r[0], leaf(r), subroot, root, proof, h, h == root))
    return out


@pytest.mark.parametrize("levels", [3, 10])
def test_manifest(docs, rows, levels):
    some = [r for r in rows if r[0] is None or r[0] % 9 == 5 or r[0] < 40 or (r[1] or "") == "x"]
    wanted = F.col("doc_id").isNull() | (F.col("doc_id") % 9 == 5) | (F.col("doc_id") < 40) | (F.col("text") == "x")
    got = merkle.audited(docs.filter(wanted), levels=levels).drop("path")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert same(got.collect(), brute_manifest(some))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_manifest_of_few_rows(spark, n):
    few = [(i, "t", "en", "s", 1) for i in range(n)]
    assert same(merkle.audited(spark.createDataFrame(few, SCHEMA), levels=2).drop("path").collect(), brute_manifest(few))


def test_manifest_of_nothing(empty):
    assert merkle.audited(empty).count() == 0


def test_proofs_need_no_join(docs):
    nodes = docs.select(F.lit("=x").alias("g"), F.lit(0).cast("long").alias("rank"), F.lit(1).cast("long").alias("n"), F.struct(F.lit("h").alias("h"), "doc_id").alias("node"))
    found = merkle.rollup(nodes.limit(1), 4)
    above = found.select("g", F.array().cast(merkle.PATH).alias("path"), F.lit("r").alias("tip"))
    plan = merkle.proofs([found], above, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


# -- alignment ---------------------------------------------------------------------------


def brute_alignment(texts):
    a_side, b_side = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_side.encode_special_tokens = True
    value = {c: b for b, c in enumerate(transducer.byte_letters())}
    found, documents = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        a, b = a_side.encode(" " + text, add_special_tokens=False), b_side.encode(text)
        raw_a = [bytes(value[c] for c in t) for t in a.tokens]
        raw_b = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_side.id_to_piece(i)) for i in b)]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            found.append(None)
            continue
        end_a, end_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        links, groups, i, j, p, q = [], [], 0, 0, 0, 0
        while i < len(end_a):
            links.append((a.ids[i], b[j]))
            x, y = end_a[i], end_b[j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(",".join(map(str, a.ids[p:i])) + "|" + ",".join(map(str, b[q:j])))
                p, q = i, j
        found.append((len(end_a), len(end_b), links, groups))
        documents.update(set(links))
    top: dict = {}
    for (x, _), n in documents.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = f
        best = sum(documents[x] == top[x[0]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(documents[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("table_bytes", [alignment.TABLE_BYTES, -1])
def test_alignment(docs, rows, table_bytes):
    got = alignment.align_tokenizers(docs, BYTES, PIECES, table_bytes=table_bytes)
    want = [(r[0], *w) for r, w in zip(rows, brute_alignment([r[1] for r in rows]))]
    assert same(got.collect(), want)
    assert sum(w[1] == 0 for w in want) > 10 and sum(w[1] > 0 for w in want) > 1000


@pytest.mark.parametrize("table_bytes", [alignment.TABLE_BYTES, -1])
def test_alignment_of_nothing(spark, empty, table_bytes):
    assert alignment.align_tokenizers(empty, BYTES, PIECES, table_bytes=table_bytes).count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    got = alignment.align_tokenizers(none, BYTES, PIECES, table_bytes=table_bytes).collect()
    assert same(got, [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_forgetting_segments_changes_nothing(texts, monkeypatch):
    aligner = alignment.Aligner(BYTES, PIECES)
    assert aligner.separable
    monkeypatch.setattr(alignment, "CACHED_SEGMENTS", 50)
    small = alignment.Aligner(BYTES, PIECES)
    for i in range(1200, 1400, 10):
        some = [t or "" for t in texts[i : i + 10]]
        (a, n), (b, m) = aligner.entries(some), small.entries(some)
        assert n.tolist() == m.tolist()
        assert [aligner.group_texts()[e] for e in a] == [small.group_texts()[e] for e in b]


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        keys = np.unique(rng.integers(0, 2**40, n))
        levels = alignment.PerfectHash.build(keys)
        assert [x[0] for x in alignment._levels(alignment._packed(levels))] == [x[0] for x in levels]
        one = alignment.PerfectHash.joined([levels], [len(keys)])
        assert sorted(one.numbers(keys, np.zeros(len(keys), np.int64)).tolist()) == list(range(len(keys)))
    parts = [np.unique(rng.integers(0, 2**40, k)) for k in (5, 0, 700)]
    many = alignment.PerfectHash.joined([alignment.PerfectHash.build(p) for p in parts], [len(p) for p in parts])
    bucket = np.repeat(np.arange(3), [len(p) for p in parts])
    assert sorted(many.numbers(np.concatenate(parts), bucket).tolist()) == list(range(len(bucket)))


def test_pair_table(docs, rows):
    counted = alignment.pair_counts(alignment.partial_counts(docs.select("text").fillna(""), BYTES, PIECES))
    base = sentencepiece.SentencePieceProcessor(model_file=PIECES).get_piece_size()
    table = alignment.pair_table(counted, base).collect()
    assert len({r["key"] for r in table}) == len(table) and all(r["key"] == r["a"] * base + r["b"] for r in table)
    assert max(r["documents"] for r in table) <= len(rows) and any(r["best"] for r in table)
