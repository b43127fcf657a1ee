"""N-gram Jaccard join with vertical partitioning.

Two documents link when the Jaccard similarity of their sets of word n-grams reaches a threshold. Links give
components. The global n-gram order (64-bit hashes) is cut into fragments; overlaps are counted fragment by fragment and
summed per pair.

1. Documents with equal sets form a class, known by a 64-bit hash of the set; from here on classes are joined.
2. Every class sends the first part of its sorted set to the fragments, packed. A fragment counts, per class, n-grams that
   another class has too. A class that lacks shared n-grams for any partner at the threshold is out. Most documents
   end here, and their pairs with everything else are never looked at. Thresholds below ``1 - TESTED`` skip this step.
3. Classes left send whole sets. Fragments return n-grams shared by two classes or more with their document
   frequency; a class with too few of them is out. The rest, rarest n-grams first, is prefix-filtered: partners at the
   threshold share an n-gram of their prefixes.
4. Classes that share a prefix n-gram are candidates. A crowd of near copies would make a candidate of each pair,
   so rounds pair all with one hub per n-gram first, then with 4 and 16, and linked classes become one component; candidates inside
   a component tell nothing new. When few pairs across components are left, all of them are taken. Every
   candidate pair is therefore verified or inside a component: no link that joins components is lost.
   A candidate also has to pass a bound from ``SKETCH_WORDS`` 64-bit words per class, the parity of its shared n-grams
   per bit: sets differ in at least as many n-grams as the words differ in bits. The bound is exact (it drops no
   link) and is tested inside the candidate join, so a crowd of texts that are alike but do not link stays small.
5. Verification: both sides' fragments of the order meet, partial overlaps are summed per pair.

A fragment holds about ``FRAGMENT_TOKENS`` n-grams at any input size. An n-gram that occurs in two documents of an input batch is
counted there and sent once, so a frequent n-gram brings one entry per batch to its fragment.

Defined results: null or empty text has an empty set and links with nothing, its component is its own id. A text
shorter than n words is one n-gram. Repeated rows and rows of one class share a component. Rows without an id take part and
get the smallest id of their component, null if it has none. An empty table gives an empty table. Only id and text are read;
``first_of_groups`` returns all columns and decides by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import star_edges
from ..operators.skew import shuffle_width
from ..session import store
from .language import text_bytes
from .shingles import mix, shingle_sets

SHINGLE = 5
SIMILAR = (4, 5)
FRAGMENT_TOKENS = 500_000
# Part of the sorted set in which shared n-grams are demanded, as a share of its size.
TESTED = 0.25
VERIFY_FRAGMENTS = 4
SKETCH_WORDS = 8
MOST_ROUNDS = 4
MORE_HUBS = 4
# Pairs left per prefix entry from which on rounds with hubs pay.
FEW_PAIRS = 1
DOCS_AT_ONCE = 2_000
ROWS_AT_ONCE = 200_000
IDS_SENT = 1_000_000
MOST_DF = 2**31 - 1


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Offset in the batch, sorted n-grams, sizes and class ids, some documents at a time."""
    for i in range(0, len(batch), DOCS_AT_ONCE):
        data, starts, sizes = text_bytes(batch.column("text").slice(i, DOCS_AT_ONCE))
        grams, n = shingle_sets(data, starts, sizes, k)
        ends = np.cumsum(n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams))])
        cid = mix(sums[ends] - sums[ends - n] + n.astype(np.uint64)).view(np.int64)
        yield i, grams, n, cid


def _body(text: str) -> Column:
    """Key of a row beside its id, which may be null or repeated."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def document_sets(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """``(doc_id, body, n, cid)``; equal sets have equal ``cid``, equal texts equal ``body``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, n, cid in _sets(batch, k):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, len(n)) for c in ("doc_id", "body")), pa.array(n.astype(np.int64)), pa.array(cid)],
                    names=["doc_id", "body", "n", "cid"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _body(text).alias("body"), F.col(text).alias("text"))
    return rows.mapInArrow(summarise, "doc_id long, body long, n long, cid long")


def least_overlap(n: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Fewest common n-grams of a set of size ``n`` with any set at the threshold."""
    return -(-n * similar[0] // similar[1])


def _pack(fragment: np.ndarray, grams: np.ndarray, cid: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    order = np.argsort(fragment, kind="stable")
    cuts = np.flatnonzero(np.diff(fragment[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(fragment[part[0]]), grams[part].tobytes(), cid[part].tobytes(), n[part].tobytes()


def _fragment_of(grams: np.ndarray, fragments: int, spread: bool) -> np.ndarray:
    """Range of the order; ``spread`` takes ranges of a second hash, for parts of sets with small hashes."""
    g = mix(grams) if spread else grams
    return ((g >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


PACKED = "fragment long, grams binary, cids binary, sizes binary"


def _unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    grams, cids, sizes = (
        np.concatenate([np.frombuffer(x, kind) for x in group[c]]) for c, kind in (("grams", "<u8"), ("cids", "<i8"), ("sizes", "<i8"))
    )
    order = np.lexsort((cids, grams))
    return grams[order], cids[order], sizes[order]


def _shared(grams: np.ndarray, cids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries to keep (one per n-gram and class) and the document frequency of each. Size -1 marks an n-gram that a batch
    has counted twice already."""
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (cids[1:] != cids[:-1])
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    weight = np.where(sizes < 0, 2, new.astype(np.int64))
    df = np.repeat(np.add.reduceat(weight, starts), np.diff(np.append(starts, len(grams))))
    return new & (sizes >= 0), df


def promising_classes(docs: DataFrame, text: str, k: int, similar: tuple[int, int], total: int) -> DataFrame:
    """Step 2: ``cid`` of classes with enough shared n-grams in the first part of their sets."""
    miss = 1 - similar[0] / similar[1]
    # An n-gram in the tested part of one set lies within this part of a partner's set.
    stored = min(1.0, TESTED * similar[1] / similar[0] + miss)
    fragments = max(shuffle_width(docs), int(total * stored) // FRAGMENT_TOKENS + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, grams, n, cid in _sets(batch, k):
                _, once = np.unique(cid, return_index=True)
                chosen = np.zeros(len(n), bool)
                chosen[once] = n[once] > 0
                first = np.cumsum(n) - n
                owner = np.repeat(np.arange(len(n)), n)
                rank = np.arange(len(grams)) - first[owner]
                use = chosen[owner] & (rank <= np.ceil(stored * n[owner]) + 1)
                g, o, r = grams[use], owner[use], rank[use]
                tested = r <= TESTED * n[o]
                # Counted here: n-grams that two documents of the batch have.
                values, inverse, counts = np.unique(g, return_inverse=True, return_counts=True)
                local = counts[inverse] > 1
                found = np.bincount(o[local & tested], minlength=len(n))
                single = ~local
                # Size 0 marks entries outside the tested part: they count for others only.
                sizes = np.where(tested[single], n[o[single]], 0)
                known = values[counts > 1]
                sent = np.concatenate([g[single], known])
                whose = np.concatenate([cid[o[single]], np.zeros(len(known), np.int64)])
                flags = np.concatenate([sizes, np.full(len(known), -1)]).astype(np.int64)
                rows = [(f, a, b, c) for f, a, b, c in _pack(_fragment_of(sent, fragments, True), sent, whose, flags)]
                out = pd.DataFrame(rows, columns=["fragment", "grams", "cids", "sizes"])
                have = np.flatnonzero(found)
                if len(have):
                    # Counts found here travel with the same table, under the batch's own fragment number.
                    own = int(cid[have[0]] % fragments)
                    out.loc[len(out)] = [-1 - own, b"", cid[have].tobytes(), (found[have] * (1 << 32) + n[have]).tobytes()]
                yield out

    def count(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            cids = np.concatenate([np.frombuffer(x, "<i8") for x in group["cids"]])
            both = np.concatenate([np.frombuffer(x, "<i8") for x in group["sizes"]])
            return pd.DataFrame({"cid": cids, "n": both & ((1 << 32) - 1), "found": both >> 32})
        grams, cids, sizes = _unpacked(group)
        own, df = _shared(grams, cids, sizes)
        hit = own & (df > 1) & (sizes > 0)
        c, inverse, found = np.unique(cids[hit], return_inverse=True, return_counts=True)
        n = np.zeros(len(c), np.int64)
        n[inverse] = sizes[hit]
        return pd.DataFrame({"cid": c, "n": n, "found": found})

    sent = docs.select(F.col(text).alias("text")).mapInArrow(_as_arrow(send), PACKED)
    counted = sent.groupBy("fragment").applyInPandas(count, "cid long, n long, found long")
    least = F.floor(F.lit(TESTED) * F.col("n")) + 1 - (F.col("n") - F.ceil(F.col("n") * similar[0] / similar[1]))
    return counted.groupBy("cid").agg(F.max("n").alias("n"), F.sum("found").alias("found")).filter(
        F.col("found") >= F.greatest(F.lit(1), least)
    ).select("cid")


def _as_arrow(send):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fragment", pa.int64()), ("grams", pa.binary()), ("cids", pa.binary()), ("sizes", pa.binary())])
        for frame in send(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    return run


def shared_grams(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, k: int, total: int, n_ids: int) -> DataFrame:
    """Step 3: ``(cid, n, df, gram)`` rows of n-grams that two of the classes share.

    ``ids`` has ``(doc_id, body, cid)``, one document of each class. Up to ``IDS_SENT`` of them (24 bytes each) go to the texts, more meet
    them in a shuffle.
    """
    fragments = total // FRAGMENT_TOKENS + 1
    wanted = ids.select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), F.col("cid").alias("_cid"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _body(text).alias("body"), F.col(text).alias("text")).join(
        F.broadcast(wanted) if n_ids <= IDS_SENT else wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))
    ).select("_cid", "text")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            expected = batch.column("_cid").to_numpy(zero_copy_only=False)
            for i, grams, n, cid in _sets(batch, k):
                # Rows that share an id but not the text are not of this class.
                own = np.repeat(cid == expected[i : i + len(n)], n)
                c, size = np.repeat(cid, n)[own], np.repeat(n, n)[own].astype(np.int64)
                g = grams[own]
                yield pd.DataFrame(list(_pack(_fragment_of(g, fragments, False), g, c, size)), columns=["fragment", "grams", "cids", "sizes"])

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        grams, cids, sizes = _unpacked(group)
        own, df = _shared(grams, cids, sizes)
        hit = np.flatnonzero(own & (df > 1))
        return pd.DataFrame(
            {"cid": cids[hit], "n": sizes[hit].astype(np.int32), "df": np.minimum(df[hit], MOST_DF).astype(np.int32), "gram": grams[hit].view(np.int64)}
        )

    sent = texts.mapInArrow(_as_arrow(send), PACKED)
    # One row per shared entry: rows grow with the input, whatever the number of fragments.
    return sent.groupBy("fragment").applyInPandas(keep, "cid long, n int, df int, gram long")


def class_rows(shared: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Shared entries put together: ``(cid, n, order, w0, w1, ...)`` of classes with enough of them for a link."""
    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    names = ["cid", "n", "dfs", "grams", *words]

    def rows(cid: np.ndarray, n: np.ndarray, df: np.ndarray, gram: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate([[True], cid[1:] != cid[:-1]]))
        size = np.diff(np.append(first, len(cid)))
        enough = size * similar[1] >= n[first] * similar[0]
        use = np.repeat(enough, size)
        first, size, n, df, gram, cid = first[enough], size[enough], n[first[enough]], df[use], gram[use], cid[first[enough]]
        offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        parity = parity_words(gram, np.repeat(np.arange(len(size)), size), len(size))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (df, gram)]
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(n), *lists, *map(pa.array, parity.T.copy())], names=names)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "n", "df", "gram")])
            if sum(len(h[0]) for h in held) < ROWS_AT_ONCE:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            # The last class may go on.
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            held = [[c[cut:] for c in columns]]
            if cut:
                yield rows(*[c[:cut] for c in columns])
        if held:
            yield rows(*[np.concatenate(c) for c in zip(*held)])

    # Rarest first within a class.
    ordered = shared.repartition("cid").sortWithinPartitions("cid", "df", "gram")
    kinds = "cid long, n int, dfs array<int>, grams array<long>, " + ", ".join(f"{w} long" for w in words)
    order = F.arrays_zip(F.col("dfs").alias("df"), F.col("grams").alias("gram"))
    return ordered.mapInArrow(together, kinds).select("cid", F.col("n").cast("long").alias("n"), order.alias("order"), *words)


def parity_words(grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Every n-gram flips one bit of its owner's ``SKETCH_WORDS`` words."""
    words = np.zeros((n, SKETCH_WORDS), np.uint64)
    h = mix(grams.astype(np.uint64))
    np.bitwise_xor.at(words, (owner, ((h >> np.uint64(6)) % np.uint64(SKETCH_WORDS)).astype(np.int64)), np.uint64(1) << (h & np.uint64(63)))
    return words.view(np.int64)


def _overlap_needed(a: Column, b: Column, similar: tuple[int, int]) -> Column:
    """Common n-grams of two sets at the threshold t: t / (1 + t) of the sum of sizes."""
    return F.ceil((a + b) * similar[0] / F.lit(float(similar[0] + similar[1])) - 1e-9)


def _verified(pairs: DataFrame, pieces: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Step 5: pairs ``(a, b)`` that link."""
    left = pieces.select(F.col("cid").alias("a"), "fragment", F.col("grams").alias("ga"), F.col("n").alias("na"))
    right = pieces.select(F.col("cid").alias("b"), "fragment", F.col("grams").alias("gb"), F.col("n").alias("nb"))
    met = pairs.join(left, "a").join(right, ["b", "fragment"])
    overlap = met.groupBy("a", "b").agg(
        F.sum(F.size(F.array_intersect("ga", "gb"))).alias("o"), F.first("na").alias("na"), F.first("nb").alias("nb")
    )
    return overlap.filter(F.col("o") * similar[1] >= (F.col("na") + F.col("nb") - F.col("o")) * similar[0]).select("a", "b")


def class_links(classes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Steps 3 to 5: ``(hi, lo)``, classes and the smallest class id of their component.

    ``classes`` has ``(cid, n, order, w0, w1, ...)`` with ``order`` the shared n-grams as (df, gram), rarest first, and
    their parity words.
    """
    pieces = store(
        classes.select("cid", "n", F.explode("order").alias("o"))
        .groupBy("cid", "n", F.pmod(F.shiftright("o.gram", 61), F.lit(VERIFY_FRAGMENTS)).alias("fragment"))
        .agg(F.collect_list("o.gram").alias("grams")),
        "jaccard-pieces",
    )
    shared = F.size("order")
    words = [f"w{i}" for i in range(SKETCH_WORDS)]
    prefix = F.col("n") - F.ceil(F.col("n") * similar[0] / F.lit(float(similar[1])) - 1e-9) + 1 - (F.col("n") - shared)
    # N-grams that no other class has are the rarest: they fill the first n - shared places of the prefix.
    entries = store(
        classes.select(
            "cid", "n", shared.alias("s"), *words, F.posexplode(F.slice("order", F.lit(1), prefix.cast("int"))).alias("pos", "o")
        ).select("cid", "n", "s", *words, (F.col("n") - F.col("s") + F.col("pos")).alias("pos"), F.col("o.gram").alias("gram")),
        "jaccard-prefixes",
    )
    sides = ["cid", "n", "s", "comp", "pos", *words]
    stars: DataFrame | None = None
    for step in range(MOST_ROUNDS):
        placed = entries.withColumn("comp", F.col("cid")) if stars is None else entries.join(
            stars.select(F.col("hi").alias("cid"), "lo"), "cid", "left"
        ).withColumn("comp", F.coalesce("lo", "cid")).drop("lo")
        per = placed.groupBy("gram").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("m"))
        open_grams = per.filter("c0 <> c1").select("gram", "m")
        live = store(placed.join(open_grams, "gram"), "jaccard-open")
        # Pairs across components: all pairs of an n-gram less those inside a component.
        size = live.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("k"), F.first("m").alias("m"))
        row = size.agg(F.sum(F.col("k") * (F.col("m") - F.col("k")) / 2).alias("pairs"), F.sum("k").alias("rows")).first()
        if not row["rows"]:
            break
        last = row["pairs"] <= FEW_PAIRS * row["rows"] or step == MOST_ROUNDS - 1
        if last:
            other = live.select("gram", *[F.col(c).alias(f"{c}_b") for c in sides])
            met = live.join(other, "gram").filter("cid < cid_b and comp <> comp_b")
        else:
            # Few hubs join most of a crowd; texts still apart meet more of them in the next round.
            draw = F.xxhash64(F.lit(step), "cid")
            hub = live.groupBy("gram", F.pmod(draw, F.lit(MORE_HUBS**step)).alias("part")).agg(
                F.min(F.struct(draw.alias("h"), *sides)).alias("hub")
            ).select("gram", *[F.col(f"hub.{c}").alias(f"{c}_b") for c in sides])
            met = live.join(hub, "gram").filter("comp <> comp_b")
        needed = _overlap_needed(F.col("n"), F.col("n_b"), similar)
        room = F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b"))
        differing = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_b"))) for w in words), F.lit(0))
        possible = met.filter(
            (F.least("n", "n_b") * similar[1] >= F.greatest("n", "n_b") * similar[0])
            # Common n-grams: at most those before this one on the shorter side, and the rest of either.
            & (room >= needed - F.least("pos", "pos_b"))
            # Common n-grams are shared ones: s + s_b less those in one set only, halved.
            & (F.col("s") + F.col("s_b") - differing >= 2 * needed)
        )
        pairs = store(
            possible.select(F.least("cid", "cid_b").alias("a"), F.greatest("cid", "cid_b").alias("b")).distinct(), "jaccard-pairs"
        )
        found = store(_verified(pairs, pieces, similar), "jaccard-links")
        # Earlier links live on in the stars.
        edges = found.select(F.col("b").alias("hi"), F.col("a").alias("lo"))
        stars = star_edges(edges if stars is None else edges.unionByName(stars.select("hi", "lo")))
        if last:
            break
    return stars if stars is not None else entries.select(F.col("cid").alias("hi"), F.col("cid").alias("lo")).limit(0)


def _first(*keys: str) -> Column:
    """Smallest ``(doc_id, *keys)``, rows without an id last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *keys))


def _components(docs: DataFrame, doc_id: str, text: str, k: int, similar: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """``document_sets`` and, for classes with n-grams, ``(cid, comp)``: the component, known by its smallest class id."""
    sets = store(document_sets(docs, doc_id, text, k), "jaccard-sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    # The test of step 2 is exact only if partners at the threshold differ in less than the tested part.
    tested = similar[0] / similar[1] >= 1 - TESTED
    near = store(
        promising_classes(docs, text, k, similar, total) if tested else sets.filter("n > 0").select("cid").distinct(), "jaccard-near"
    )
    chosen = store(
        sets.join(near, "cid").groupBy("cid").agg(_first("body").alias("f"), F.max("n").alias("n")).select("cid", "f.doc_id", "f.body", "n"),
        "jaccard-chosen",
    )
    left = chosen.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids")).first()
    grams = shared_grams(docs, chosen, doc_id, text, k, left["n"] or 0, left["ids"])
    classes = store(class_rows(grams, similar), "jaccard-classes")
    stars = class_links(classes, similar).select(F.col("hi").alias("cid"), "lo")
    known = sets.filter("n > 0").select("cid").distinct()
    return sets, store(known.join(stars, "cid", "left").select("cid", F.coalesce("lo", "cid").alias("comp")), "jaccard-comps")


def similar_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id."""
    sets, comps = _components(docs, doc_id, text, k, similar)
    by_class = sets.filter("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first"))
    grouped = store(by_class.join(comps, "cid"), "jaccard-grouped")
    least = grouped.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = store(grouped.join(least, "comp").select("cid", "component_id"), "jaccard-named")
    return sets.join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def first_of_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """One row of ``docs`` per component, and all rows with null or empty text.

    The row with the smallest id stays; rows without an id come after all others. Of several such rows it is one with the smallest class id and
    text hash, of equal texts the one with the smallest hash of its columns. Ids may repeat: rows count by id and text.
    """
    sets, comps = _components(docs, doc_id, text, k, similar)
    keys = store(sets.groupBy("doc_id", "body", "cid").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("c")), "jaccard-keys")
    firsts = keys.filter("n > 0").join(comps, "cid").groupBy("comp").agg(_first("cid", "body", "c").alias("f"))
    empty = keys.filter("n = 0").select("doc_id", "body", F.lit(False).alias("_again"))
    stay = store(firsts.select("f.doc_id", "f.body", (F.col("f.c") > 1).alias("_again")).unionByName(empty), "jaccard-stay")
    names = [F.col(f"`{c}`") for c in docs.columns]
    # Maps have no hash.
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])
    whole = docs.select(
        F.struct(*names).alias("row"), tie.alias("_tie"), F.col(doc_id).cast("long").alias("_id"), _body(text).alias("_body")
    )
    marked = whole.join(stay, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_body") == F.col("body"))).select("row", "_tie", "_id", "_body", "_again")
    # Repeated rows meet in each input partition first.
    one = marked.filter("_again").groupBy("_id", "_body").agg(F.min_by("row", "_tie").alias("row"))
    return marked.filter("not _again").select("row.*").unionByName(one.select("row.*"))
