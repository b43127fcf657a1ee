"""Language identification with a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes, all of it. In each window one network reads forward, one
backward; together they label every byte position, and the position probabilities of a document are averaged. Gates
use clipped linear units instead of sigmoid and tanh, which cost a fraction of the time on a CPU. Training is backpropagation through
time with Adam, in numpy, on a bounded sample: at most ``SAMPLE_DOCS`` documents per language, those with the smallest hash of their
id, and of each at most ``DOC_WINDOWS`` windows spread over the whole text. Languages are all labels of the sample's table.

Defined results: null text, or text without a letter, is ``und`` with score 0. Rows without an id are not held out and not learned from.
Without any label everything is ``und``. Repeated rows get equal results. An empty table gives an empty table. Only id,
text and, for training, lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import held_out

WINDOW = 64
HIDDEN = 8
SAMPLE_DOCS = 400
DOC_WINDOWS = 8
STEPS = 500
BATCH = 192
RATE = 0.01
ROWS = 2048
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def clip_gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


@dataclass
class Network:
    """Per direction: byte inputs E (256, 3H), recurrent U (H, 3H); output V (2H, L), c (L)."""

    langs: list[str]
    E: list[np.ndarray]
    U: list[np.ndarray]
    V: np.ndarray
    c: np.ndarray


def new_network(langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    make = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return Network(
        langs,
        [make(256, 3 * hidden) for _ in range(2)],
        [make(hidden, 3 * hidden) for _ in range(2)],
        make(2 * hidden, len(langs)),
        np.zeros(len(langs), np.float32),
    )


def _run(net: Network, x: np.ndarray, mask: np.ndarray | None, side: int, keep: list | None = None) -> np.ndarray:
    """States (T, H, B) of one direction; x is (T, B). Masked positions keep state zero."""
    steps, width = x.shape
    hidden = net.U[side].shape[0]
    table, recurrent = np.ascontiguousarray(net.E[side].T), np.ascontiguousarray(net.U[side].T)
    states = np.zeros((steps, hidden, width), np.float32)
    h = np.zeros((hidden, width), np.float32)
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        a = table[:, x[t]]
        u = recurrent @ h
        gates = a[: 2 * hidden] + u[: 2 * hidden]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0, 1, out=gates)
        z, r = gates[:hidden], gates[hidden:]
        n = u[2 * hidden :] * r
        n += a[2 * hidden :]
        np.clip(n, -1, 1, out=n)
        if keep is not None:
            keep.append((t, h, z, r, n, u[2 * hidden :]))
        new = h - n
        new *= z
        new += n
        if mask is not None:
            new *= mask[t]
        h = new
        states[t] = h
    return states


def position_probabilities(net: Network, x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """(T, L, B): softmax over languages at every position of the windows x (T, B)."""
    forward, backward = _run(net, x, mask, 0), _run(net, x, mask, 1)
    h = net.U[0].shape[0]
    logits = np.matmul(net.V[:h].T, forward) + np.matmul(net.V[h:].T, backward) + net.c[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(net: Network, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over positions and its gradients in the order E0, E1, U0, U1, V, c."""
    kept: list[list] = [[], []]
    states = [_run(net, x, mask, side, kept[side]) for side in (0, 1)]
    hidden = net.U[0].shape[0]
    logits = np.matmul(net.V[:hidden].T, states[0]) + np.matmul(net.V[hidden:].T, states[1]) + net.c[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    steps, width = x.shape
    total = mask.sum()
    right = p[:, y, np.arange(width)]
    loss = float(-(np.log(right + 1e-9) * mask).sum() / total)
    d_logits = p
    d_logits[:, y, np.arange(width)] -= 1
    d_logits *= (mask / total)[:, None, :]
    d_c = d_logits.sum(axis=(0, 2))
    d_e, d_u, d_v = [], [], []
    for side in (0, 1):
        own = net.V[side * hidden : (side + 1) * hidden]
        d_v.append(np.einsum("thb,tlb->hl", states[side], d_logits))
        d_states = np.matmul(own, d_logits)
        e_grad, u_grad = np.zeros_like(net.E[side]), np.zeros_like(net.U[side])
        carried = np.zeros((hidden, width), np.float32)
        for t, h, z, r, n, u_n in reversed(kept[side]):
            d = (d_states[t] + carried) * mask[t]
            d_n = d * (1 - z) * (np.abs(n) < 1)
            d_z = d * (h - n) * 0.25 * ((z > 0) & (z < 1))
            d_r = d_n * u_n * 0.25 * ((r > 0) & (r < 1))
            d_a = np.concatenate([d_z, d_r, d_n])
            d_rec = np.concatenate([d_z, d_r, d_n * r])
            carried = d * z + net.U[side] @ d_rec
            u_grad += h @ d_rec.T
            np.add.at(e_grad, x[t], d_a.T)
        d_e.append(e_grad)
        d_u.append(u_grad)
    return loss, [*d_e, *d_u, np.concatenate(d_v), d_c]


def fit(windows: np.ndarray, lengths: np.ndarray, y: np.ndarray, langs: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Windows (n, T) of bytes with their lengths and language numbers; every language is drawn as often."""
    net = new_network(langs, seed=seed)
    rng = np.random.default_rng(seed)
    members = [np.flatnonzero(y == k) for k in range(len(langs))]
    values = [*net.E, *net.U, net.V, net.c]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    each = max(1, BATCH // len(langs))
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(m, each) for m in members])
        x = np.ascontiguousarray(windows[rows].T)
        mask = (np.arange(x.shape[0])[:, None] < lengths[rows]).astype(np.float32)
        _, grads = gradients(net, x, y[rows], mask)
        size = np.sqrt(sum(float((g**2).sum()) for g in grads))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for v, g, a, b in zip(values, grads, first, second):
            g *= min(1.0, 1.0 / (size + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def cut_windows(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and length of the windows of consecutive texts in one buffer."""
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[owner] + place * WINDOW
    return owner, begin, np.minimum(WINDOW, starts[owner] + sizes[owner] - begin)


def document_probabilities(net: Network, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(documents, languages): probabilities averaged over all byte positions."""
    owner, begin, length = cut_windows(starts, sizes)
    sums = np.zeros((len(sizes), len(net.langs)))
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    # Whole windows need no mask.
    for part, masked in ((np.flatnonzero(length == WINDOW), False), (np.flatnonzero(length < WINDOW), True)):
        for i in range(0, len(part), ROWS):
            own = part[i : i + ROWS]
            x = padded[begin[own] + np.arange(WINDOW)[:, None]]
            mask = (np.arange(WINDOW)[:, None] < length[own]).astype(np.float32) if masked else None
            p = position_probabilities(net, x, mask)
            pooled = p.sum(axis=0) if mask is None else (p * mask[:, None, :]).sum(axis=0)
            np.add.at(sums, owner[own], pooled.T)
    return sums / np.maximum(sizes, 1)[:, None]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and sizes of an Arrow string column, without copying texts."""
    big = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(big.buffers()[1], np.int64)[big.offset : big.offset + len(big) + 1]
    data = big.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Fit on labelled documents that aren't held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")
    )
    counts = store(rows.groupBy("lang").count(), "lang-counts")
    langs = sorted(r["lang"] for r in counts.collect())
    if not langs:
        return None
    # A sample of each language by hash: rate from its count, so that no group is gathered or sorted whole.
    rate = F.lit(SAMPLE_DOCS * 1.3) / F.col("count")
    unit = (F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("u")
    near = rows.join(counts, "lang").select("doc_id", "lang", "count", unit).filter(F.col("u") < rate).select("doc_id", "lang").distinct()
    chosen = store(near.withColumnRenamed("lang", "label"), "lang-sample")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for label, body in zip(batch["label"], batch["text"]):
                data = body.encode("utf-8", "replace")
                n = -(-len(data) // WINDOW)
                for k in sorted({i * n // DOC_WINDOWS for i in range(DOC_WINDOWS)}) if n else []:
                    out.append((label, data[k * WINDOW : (k + 1) * WINDOW]))
            yield pd.DataFrame(out, columns=["label", "window"])

    # The sample is bounded by its rate, languages times SAMPLE_DOCS, and so is the broadcast.
    cut = texts.join(F.broadcast(chosen), "doc_id").select("label", "text").mapInPandas(windows, "label string, window binary")
    sample = sorted((r["label"], bytes(r["window"])) for r in cut.collect())
    if not sample:
        return None
    number = {k: i for i, k in enumerate(langs)}
    found = np.zeros((len(sample), WINDOW), np.uint8)
    for row, (_, data) in zip(found, sample):
        row[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.array([len(d) for _, d in sample])
    y = np.array([number[k] for k, _ in sample])
    present = np.unique(y)
    return fit(found, lengths, np.searchsorted(present, y), [langs[k] for k in present])


def identify(docs: DataFrame, net: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            lang = [UNKNOWN] * len(batch)
            score = np.zeros(len(batch))
            if net is not None and len(batch):
                data, starts, sizes = text_bytes(column)
                p = document_probabilities(net, data, starts, sizes)
                best = p.argmax(axis=1)
                for i in range(len(batch)):
                    body = column[i].as_py()
                    if body and LETTER.search(body):
                        lang[i], score[i] = net.langs[best[i]], min(1.0, p[i, best[i]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    return identify(docs, train(docs, doc_id, text, lang), doc_id, text)
