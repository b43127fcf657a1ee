"""Removal of repeated byte strings with a distributed merge sort of suffixes.

Every byte inside a string of ``LENGTH`` bytes that starts anywhere else too is removed. Sorted suffixes show repeats as
neighbours with a long common prefix, but a suffix per byte is more than needed:

1. Each possible start s has an anchor, the position with the smallest hash among the ``WINDOW`` positions from s on.
   The anchor depends on the string alone, so equal strings have equal anchors. About one byte in fifty is an anchor.
2. The ``LENGTH - WINDOW`` bytes from an anchor lie inside every string of its starts. Anchors whose bytes
   there occur once in the corpus (by hash, counted in fragments) are out. So are most texts.
3. Each task sorts the suffixes at its remaining anchors and sends front-coded runs: per suffix the prefix length in common with the
   one before, and the rest. Runs of a fragment are merged by a loser tree that carries common prefix
   lengths: of two heads the one that agrees longer with the last output is smaller, and bytes are compared only from the known
   common prefix on. The merge yields sorted suffixes with their common prefix lengths.
4. The string that starts a bytes before an anchor occurs elsewhere if another anchor agrees with it on a bytes to the
   left and ``LENGTH`` - a to the right. At each common prefix length, groups of suffixes are ordered by reversed left context; neighbours agree
   longest. That decides all starts of an anchor, exactly: strings are compared, not hashes.

Equal texts are one text (by 64-bit hash and size) until the end; a text that occurs twice repeats everything. Contexts that occur twice in a task
are sent once. An anchor at the edge of a common passage has a context of its own per document, below 300 bytes each.

Defined results: null and empty text give no bytes and nothing removed; texts below ``LENGTH`` bytes can't repeat. Repeated rows repeat each
other. Ids are only carried along, null included. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import shuffle_width
from ..session import store
from .language import text_bytes
from .shingles import mix

LENGTH = 200
WINDOW = 100
KEY = LENGTH - WINDOW
FRAGMENT_ANCHORS = 1_000_000
DOCS_AT_ONCE = 2_000


def _loads(data: np.ndarray) -> np.ndarray:
    """At each position the eight bytes from there as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data) + 8, "<u8")
    for k in range(8):
        part = padded[k : k + (len(padded) - k) // 8 * 8].view("<u8")
        out[k::8] = part[: len(out[k::8])]
    return out


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts in one buffer: owner, anchor position, first and last start of each anchor, key hash."""
    loads = _loads(data)
    h = mix(loads[: len(data)] * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFF00000000)
    best = h | np.arange(len(data), dtype=np.uint64)
    # Minimum over WINDOW positions by doubling; a tie goes to the first.
    width = 1
    while width * 2 <= WINDOW:
        best[:-width] = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = WINDOW - width
    if rest and len(best) > rest:
        best[:-rest] = np.minimum(best[:-rest], best[rest:])
    n_starts = np.maximum(sizes - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), n_starts)
    first = np.cumsum(n_starts) - n_starts
    s = np.arange(len(owner)) + np.repeat(starts - first, n_starts)
    at = (best[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(s)) - 1 if len(head) else head
    i = at[head]
    key = np.zeros(len(i), np.uint64)
    for k in range(0, KEY - 7, 8):
        key = mix((key ^ loads[i + k]) * np.uint64(0xD6E8FEB86659FD93))
    if KEY % 8:
        key = mix((key ^ loads[i + KEY - 8]) * np.uint64(0xD6E8FEB86659FD93))
    return owner[head], i, s[head], s[tail], key


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(0, len(batch), DOCS_AT_ONCE):
        data, starts, sizes = text_bytes(batch.column("text").slice(i, DOCS_AT_ONCE))
        low, high = (int(starts[0]), int(starts[-1] + sizes[-1])) if len(sizes) else (0, 0)
        yield i, data[low:high], starts - low, sizes


def _fragment_of(key: np.ndarray, fragments: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


def _split(fragment: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(fragment, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(fragment[order])) + 1) if len(order) else []


def repeated_anchors(texts: DataFrame, fragments: int) -> DataFrame:
    """Step 2: ``(cid, places)``: packed positions of anchors whose key occurs twice."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column("cid").to_numpy()
            for i, data, starts, sizes in _chunks(batch):
                ids = all_ids[i : i + len(sizes)]
                owner, at, _, _, key = anchors(data, starts, sizes)
                _, once = np.unique(ids, return_index=True)
                single = np.zeros(len(ids), bool)
                single[once] = True
                use = single[owner]
                owner, place, key = owner[use], (at - starts[owner])[use], key[use]
                cid = ids[owner]
                _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
                local = counts[inverse] > 1
                # Twice here: known to repeat. One entry tells the others, the rest stay out of its fragment.
                first = np.zeros(len(key), bool)
                first[np.unique(key, return_index=True)[1]] = True
                rows = []
                for part in _split(_fragment_of(key, fragments)):
                    part = part[~local[part] | first[part]]
                    if len(part):
                        flag = np.where(local[part], -1 - place[part], place[part])
                        rows.append((int(_fragment_of(key[part[:1]], fragments)[0]), key[part].tobytes(), cid[part].tobytes(), flag.tobytes()))
                known = np.flatnonzero(local & ~first)
                if len(known):
                    rows.append((-1 - int(cid[known[0]] % fragments), b"", cid[known].tobytes(), place[known].tobytes()))
                yield pa.RecordBatch.from_pydict(
                    {"fragment": [r[0] for r in rows], "keys": [r[1] for r in rows], "cids": [r[2] for r in rows], "places": [r[3] for r in rows]},
                    schema=pa.schema([("fragment", pa.int64()), ("keys", pa.binary()), ("cids", pa.binary()), ("places", pa.binary())]),
                )

    def keep(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        cids, places = (np.concatenate([np.frombuffer(x, "<i8") for x in group[c]]) for c in ("cids", "places"))
        if key[0] >= 0:
            keys = np.concatenate([np.frombuffer(x, "<u8") for x in group["keys"]])
            order = np.lexsort((np.where(places < 0, -1 - places, places), cids, keys))
            keys, cids, places = keys[order], cids[order], places[order]
            real = np.where(places < 0, -1 - places, places)
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (cids[1:] != cids[:-1]) | (real[1:] != real[:-1])
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.add.reduceat(np.where(places < 0, 2, new.astype(np.int64)), starts)
            hit = new & (np.repeat(counts, np.diff(np.append(starts, len(keys)))) > 1)
            cids, places = cids[hit], real[hit]
        order = np.argsort(cids, kind="stable")
        cids, places = cids[order], places[order]
        cuts = np.flatnonzero(np.diff(cids)) + 1
        parts = np.split(places, cuts) if len(cids) else []
        heads = cids[np.append(0, cuts)] if len(cids) else cids
        return pd.DataFrame({"cid": heads, "places": [p.astype("<i8").tobytes() for p in parts]})

    sent = texts.select("cid", "text").mapInArrow(send, "fragment long, keys binary, cids binary, places binary")
    return sent.groupBy("fragment").applyInPandas(keep, "cid long, places binary")


class Run:
    """A sorted run: front-coded suffixes with what belongs to each."""

    def __init__(self, row):
        self.common = row["common"]
        self.tails, self.tail_sizes = row["tails"], np.frombuffer(row["tail_sizes"], np.uint8).tolist()
        self.at = -1
        self.offset = 0
        self.suffix = b""

    def next(self) -> bool:
        """Move to the next suffix; ``known`` is its common prefix with the one before."""
        self.at += 1
        if self.at == len(self.common):
            return False
        self.known = self.common[self.at]
        size = self.tail_sizes[self.at]
        self.suffix = self.suffix[: self.known] + self.tails[self.offset : self.offset + size]
        self.offset += size
        return True


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparison."""
    m = min(len(a), len(b))
    x = int.from_bytes(a[known:m], "big") ^ int.from_bytes(b[known:m], "big")
    return m - (x.bit_length() + 7) // 8


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """Run number, place in it, suffix, common prefix with the output before, in sorted order.

    A tree of losers. Every loser keeps its common prefix with the winner that beat it, which is the last output on its path. Of two
    candidates the one with the longer common prefix with the last output is smaller; only on a tie are bytes compared, from there on.
    """
    live = [r.next() for r in runs]
    size = 1
    while size < len(runs):
        size *= 2
    losers: list[tuple[int, int]] = [(-1, 0)] * size

    def play(a: tuple[int, int], b: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        """Winner and loser; the loser's length becomes that with the winner."""
        if a[0] < 0 or not live[a[0]]:
            return b, a
        if b[0] < 0 or not live[b[0]]:
            return a, b
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)
        x, y = runs[a[0]].suffix, runs[b[0]].suffix
        n = common_prefix(x, y, a[1])
        if x[n : n + 1] < y[n : n + 1] or (x[n : n + 1] == y[n : n + 1] and a[0] < b[0]):
            return a, (b[0], n)
        return b, (a[0], n)

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            k = node - size
            return (k, 0) if k < len(runs) else (-1, 0)
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if size > 1 else (0, 0)
    while winner[0] >= 0 and live[winner[0]]:
        k, known = winner
        run = runs[k]
        yield k, run.at, run.suffix, known
        live[k] = run.next()
        winner = (k, run.known if live[k] else 0)
        node = (k + size) // 2
        while node >= 1 and size > 1:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


RUN = (
    "fragment long, common binary, tails binary, tail_sizes binary, lefts binary, left_sizes binary, nearest binary, cids binary, places binary"
)


def sorted_runs(texts: DataFrame, fragments: int) -> DataFrame:
    """Step 3: front-coded runs of ``(cid, text, places)``; contexts that occur twice in a batch are sent once,
    with place -1 - place for "repeats all over"."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RUN.split(", ")]
        for batch in batches:
            all_ids = batch.column("cid").to_numpy()
            wanted = batch.column("places")
            for i, data, starts, sizes in _chunks(batch):
                ids = all_ids[i : i + len(sizes)]
                owner, at, low, high, key = anchors(data, starts, sizes)
                place = at - starts[owner]
                chosen = np.zeros(len(at), bool)
                bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
                for d in range(len(sizes)):
                    a, b = bounds[d], bounds[d + 1]
                    if b > a:
                        mine = np.frombuffer(b"".join(wanted[i + d].as_py()), "<i8")
                        chosen[a:b] = np.isin(place[a:b], mine)
                body = data.tobytes()
                ends = (starts + sizes).tolist()
                rows, done = [], []
                for part in _split(np.where(chosen, _fragment_of(key, fragments), -1)):
                    if not chosen[part[0]]:
                        continue
                    items: dict[tuple[bytes, bytes, int], list[int]] = {}
                    for p in part.tolist():
                        x = int(at[p])
                        context = (body[x : min(x + LENGTH, ends[owner[p]])], body[int(low[p]) : x], x - int(high[p]))
                        items.setdefault(context, []).append(p)
                    order = sorted(items, key=lambda c: c[0])
                    common, tails = bytearray(), []
                    before = b""
                    for right, _, _ in order:
                        n = common_prefix(before, right, 0)
                        common.append(n)
                        tails.append(right[n:])
                        before = right
                    mine = [items[c] for c in order]
                    flags = [-1 - int(place[m[0]]) if len(m) > 1 else int(place[m[0]]) for m in mine]
                    for m in mine:
                        if len(m) > 1:
                            done += m[1:]
                    rows.append(
                        (
                            int(_fragment_of(key[part[:1]], fragments)[0]), bytes(common), b"".join(tails), bytes(map(len, tails)),
                            b"".join(c[1] for c in order), bytes(len(c[1]) for c in order), bytes(c[2] for c in order),
                            ids[owner[[m[0] for m in mine]]].tobytes(), np.array(flags, np.int64).tobytes(),
                        )
                    )
                if done:
                    # Their starts repeat whatever the others hold: sent as finished ranges.
                    d = np.array(done)
                    s0, s1 = low[d] - starts[owner[d]], high[d] - starts[owner[d]]
                    rows.append((-1 - int(ids[owner[d[0]]] % fragments), b"", b"", b"", b"", b"", np.stack([s0, s1], 1).tobytes(), ids[owner[d]].tobytes(), b""))
                yield pd.DataFrame(rows, columns=names)

    def as_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.binary()) for x in RUN.split(", ")])
        for frame in send(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    return texts.select("cid", "text", "places").mapInArrow(as_arrow, RUN)


def repeated_starts(suffixes: np.ndarray, lefts: list[bytes], nearest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Step 4. ``suffixes`` holds common prefix lengths with the suffix before, in sorted order; ``nearest`` the least distance
    a start has from its anchor. Yields member numbers with ranges of distances that repeat."""
    n = len(lefts)
    size = np.array([len(x) for x in lefts])
    reverse = np.zeros((n, WINDOW), np.uint8)
    for row, left in zip(reverse, lefts):
        row[: len(left)] = np.frombuffer(left[::-1], np.uint8)
    rank = np.empty(n, np.int64)
    rank[np.array(sorted(range(n), key=lambda i: lefts[i][::-1]), np.int64)] = np.arange(n)
    cluster = np.cumsum(suffixes < KEY + 1)
    # Distinct common prefix lengths of each cluster, longest first: between two of them groups stay as they are.
    inner = np.flatnonzero(suffixes >= KEY + 1)
    levels = np.unique(np.stack([cluster[inner], np.minimum(suffixes[inner], LENGTH)], 1), axis=0) if len(inner) else np.zeros((0, 2), np.int64)
    nexts = np.append(levels[1:, 1], 0)
    # Rows ascend in level inside a cluster: the level below stands one row before.
    below = np.where(np.append(-1, levels[:-1, 0]) == levels[:, 0], np.append(0, levels[:-1, 1]), KEY) if len(levels) else nexts[:0]
    for level in np.unique(levels[:, 1])[::-1]:
        rows = np.flatnonzero(levels[:, 1] == level)
        lower = np.full(cluster[-1] + 1, -1)
        lower[levels[rows, 0]] = below[rows]
        members = np.flatnonzero(lower[cluster] >= 0)
        group = np.cumsum(suffixes < level)[members]
        order = np.lexsort((rank[members], group))
        m, g = members[order], group[order]
        same = g[1:] == g[:-1]
        a, b = m[:-1][same], m[1:][same]
        agree = np.zeros(len(a), np.int64)
        for i in range(0, len(a), 50_000):
            equal = reverse[a[i : i + 50_000]] == reverse[b[i : i + 50_000]]
            agree[i : i + 50_000] = np.where(equal.all(axis=1), WINDOW, equal.argmin(axis=1))
        agree = np.minimum(agree, np.minimum(size[a], size[b]))
        most = np.full(n, -1)
        np.maximum.at(most, a, agree)
        np.maximum.at(most, b, agree)
        own = m[most[m] >= 0]
        first = np.maximum(nearest[own], LENGTH - level)
        last = np.minimum(np.minimum(most[own], size[own]), LENGTH - lower[cluster[own]] - 1)
        good = last >= first
        yield own[good], first[good], last[good]


def _merge_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    if key[0] < 0:
        cids = np.concatenate([np.frombuffer(x, "<i8") for x in group["cids"]])
        both = np.concatenate([np.frombuffer(x, "<i8") for x in group["nearest"]]).reshape(-1, 2)
        found = [(cids, both[:, 0], both[:, 1])]
    else:
        rows = group.to_dict("records")
        # Equal work in an equal order on every attempt.
        rows.sort(key=lambda r: (r["cids"], r["places"], r["tails"]))
        left_cuts = [np.concatenate([[0], np.cumsum(np.frombuffer(r["left_sizes"], np.uint8).astype(np.int64))]).tolist() for r in rows]
        all_cids = [np.frombuffer(r["cids"], "<i8") for r in rows]
        all_places = [np.frombuffer(r["places"], "<i8") for r in rows]
        common, lefts, near, cids, places = [], [], [], [], []
        for k, at, _, known in merge_runs([Run(r) for r in rows]):
            common.append(known)
            lefts.append(rows[k]["lefts"][left_cuts[k][at] : left_cuts[k][at + 1]])
            near.append(rows[k]["nearest"][at])
            cids.append(all_cids[k][at])
            places.append(all_places[k][at])
        cid, place, near_at = np.array(cids, np.int64), np.array(places, np.int64), np.array(near, np.int64)
        known = place < 0
        place = np.where(known, -1 - place, place)
        size = np.array([len(x) for x in lefts])
        found = [(cid[known], (place - size)[known], (place - near_at)[known])]
        for own, first, last in repeated_starts(np.array(common), lefts, near_at):
            found.append((cid[own], place[own] - last, place[own] - first))
    c, s0, s1 = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((s0, c))
    c, s0, s1 = c[order], s0[order], s1[order]
    cuts = np.flatnonzero(np.diff(c)) + 1
    parts = np.split(np.stack([s0, s1], 1).astype("<i8"), cuts) if len(c) else []
    return pd.DataFrame({"cid": c[np.append(0, cuts)] if len(c) else c, "ranges": [p.tobytes() for p in parts]})


def removed_runs(ranges: np.ndarray) -> np.ndarray:
    """Maximal byte runs (start, end) covered by the strings that start in ``ranges`` (first, last)."""
    if not len(ranges):
        return np.zeros((0, 2), np.int64)
    r = ranges[np.argsort(ranges[:, 0], kind="stable")]
    start, end = r[:, 0], np.maximum.accumulate(r[:, 1] + LENGTH)
    new = np.ones(len(r), bool)
    new[1:] = start[1:] > end[:-1]
    heads = np.flatnonzero(new)
    return np.stack([start[heads], end[np.append(heads[1:], len(r)) - 1]], 1)


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text, ranges of repeated starts (packed) and whether the whole text repeats."""
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content, F.octet_length(content)).alias("cid")
    )
    classes = store(
        keyed.groupBy("cid").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.max(F.octet_length("text")).alias("n")),
        "suffix-classes",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0
    fragments = max(shuffle_width(docs), total * 2 // WINDOW // FRAGMENT_ANCHORS + 1)
    places = store(
        repeated_anchors(keyed, fragments).groupBy("cid").agg(F.collect_list("places").alias("places")), "suffix-anchors"
    )
    wanted = store(places.join(classes.select("cid", "first"), "cid"), "suffix-wanted")
    # One row of each class; its copies are joined at the end.
    one = keyed.join(wanted.withColumnRenamed("cid", "_cid"), (F.col("cid") == F.col("_cid")) & F.col("doc_id").eqNullSafe(F.col("first")))
    ranges = store(
        sorted_runs(one, fragments).groupBy("fragment").applyInPandas(_merge_group, "cid long, ranges binary").groupBy("cid").agg(F.collect_list("ranges").alias("ranges")),
        "suffix-ranges",
    )
    copies = classes.filter("copies > 1").select("cid", F.lit(True).alias("whole"))
    marks = store(ranges.join(copies, "cid", "full"), "suffix-marks")
    return keyed.join(marks, "cid", "left").select("doc_id", "text", "ranges", F.coalesce("whole", F.lit(False)).alias("whole"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the remaining bytes."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, sizes = text_bytes(batch.column("text"))
            packed, whole = batch.column("ranges"), batch.column("whole").to_pylist()
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for i in range(len(batch)):
                body = data[starts[i] : starts[i] + sizes[i]]
                if whole[i] and len(body) >= LENGTH:
                    runs = np.array([[0, len(body)]])
                else:
                    runs = removed_runs(np.frombuffer(b"".join(packed[i].as_py() or []), "<i8").reshape(-1, 2))
                keep = np.ones(len(body), bool)
                for a, b in runs.tolist():
                    keep[a:b] = False
                kept = body[keep].tobytes() if len(runs) else body.tobytes()
                out["n_bytes"].append(len(body))
                out["n_removed"].append(len(body) - len(kept))
                out["n_spans"].append(len(runs))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_bytes:
                    out["kept"].append(kept)
            columns = [batch.column("doc_id")] + [pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]
            columns.append(pa.array(out["kept_sha256"], pa.string()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns.append(pa.array(out["kept"], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return find_repeats(docs, doc_id, text).mapInArrow(remove, schema)
