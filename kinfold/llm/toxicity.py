"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents marked toxic, everything else is unlabelled text: it holds toxic documents too.
With class prior p, risk on positives and risk of calling unlabelled text clean give the risk on clean text
as R_u(-) - p R_p(-). Where that estimate turns negative the fit has learned the sample by heart; then only its
reverse gradient is followed (Kiryo et al. 2017). The model is linear on the presence of words, logistic loss,
Adam, in numpy.

Fitting is on a bounded sample: at most ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` other documents, those
with the smallest hash of their id, whole texts, copies taken once. The vocabulary is words of at least
``MIN_SHARE`` of the sampled positives that are ``ENRICHED`` times as common there as in the rest: it is bounded by the sample, and words of
a few copied documents don't pass for toxic ones. The prior is the toxic share of all
labelled training rows unless given. Scoring reads every whole text.

Defined results: null and empty texts get the score of a text without known words. Rows without id are in no training sample and
not held out. Labels that are null, or belong to no document, are ignored; a repeated label row counts once,
and a document with conflicting labels is toxic. Without positives the score is the prior, 0.01 at least. An empty table
gives an empty table. Only id and text are read from documents, id and ``toxic`` from labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import held_out

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
MIN_SHARE = 0.01
LEAST_DOCS = 5
ENRICHED = 2
ROUNDS = 150
RATE = 0.1
DECAY = 2e-4
WORDS = re.compile(r"[^\W_]+")


def words_in(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = words_in(text) & self.weights.keys()
        total = self.bias + sum(sorted(self.weights[w] for w in found))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit_nnpu(
    n_features: int, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Weights and bias; a document is an array of feature numbers."""
    docs = positive + unlabelled
    lengths = np.array([len(d) for d in docs])
    index = np.concatenate(docs).astype(np.int64) if lengths.sum() else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), lengths)
    is_positive = np.arange(len(docs)) < len(positive)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    w, first, second = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, rounds + 1):
        f = np.bincount(owner, w[index], len(docs)) + w[-1]
        sigma = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        # Logistic loss: towards toxic -ln sigma, towards clean -ln(1 - sigma).
        clean_loss = np.logaddexp(0, f)
        clean_risk = clean_loss[~is_positive].sum() / n_u - prior * clean_loss[is_positive].sum() / n_p
        toward_clean = np.where(is_positive, -prior / n_p, 1 / n_u) * sigma
        if clean_risk >= 0:
            g = np.where(is_positive, prior / n_p * (sigma - 1), 0) + toward_clean
        else:
            g = -toward_clean
        grad = np.append(np.bincount(index, g[owner], n_features), g.sum())
        grad[:-1] += DECAY * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", prior: float | None = None) -> Model:
    """Fit on the documents that aren't held out."""
    marks = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    if prior is None:
        row = marks.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
        prior = (row["toxic"] or 0) / row["n"] if row["n"] else 0.0
    prior = float(np.clip(prior, 0.01, 0.5))
    order = F.xxhash64(F.lit("sample"), "doc_id")
    positives = marks.filter("toxic = 1").orderBy(order, "doc_id").limit(MAX_POSITIVE).select("doc_id", F.lit(True).alias("positive"))
    ids = docs.select(F.col(doc_id).alias("doc_id")).filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    others = ids.orderBy(order, "doc_id").limit(MAX_UNLABELLED).select("doc_id", F.lit(False).alias("positive"))
    chosen = store(positives.unionByName(others).distinct(), "toxic-sample")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"positive": batch["positive"], "key": batch["key"], "words": [sorted(words_in(t)) for t in batch["text"]]})

    # The sample is bounded by the two limits above, and so is the broadcast.
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").select(
        "positive", F.xxhash64("text").alias("key"), "text"
    )
    sample = store(texts.mapInPandas(split, "positive boolean, key long, words array<string>").dropDuplicates(["positive", "key"]), "toxic-words")
    n_positive = sample.filter("positive").count()
    if not n_positive:
        return Model({}, float(np.log(prior / (1 - prior))))
    n_other = sample.filter("not positive").count()
    counted = (
        sample.select("positive", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if("positive").alias("toxic"), F.count_if(~F.col("positive")).alias("other"))
        .filter(
            (F.col("toxic") >= max(LEAST_DOCS, int(MIN_SHARE * n_positive)))
            & (F.col("toxic") * n_other >= ENRICHED * n_positive * F.col("other"))
        )
    )
    words = sorted(r["word"] for r in counted.select("word").collect())
    number = {w: i for i, w in enumerate(words)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[number[w] for w in ws if w in number] for ws in batch["words"]]
            yield pd.DataFrame({"positive": batch["positive"], "features": found})

    rows = sample.orderBy("key", "positive").select("positive", "words").mapInPandas(encode, "positive boolean, features array<int>").collect()
    sides: tuple[list, list] = ([], [])
    for r in rows:
        sides[not r["positive"]].append(np.array(r["features"], np.int64))
    weights, bias = fit_nnpu(len(words), sides[0], sides[1], prior)
    return Model({w: float(x) for w, x in zip(words, weights) if abs(x) > 1e-3}, bias)


def score_toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.array([model.score(t) for t in batch["text"]], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores})

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    scored = rows.mapInPandas(score, "doc_id string, held_out boolean, score double")
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def judge_toxicity(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    return score_toxicity(docs, train(docs, labels, **columns), **columns)
