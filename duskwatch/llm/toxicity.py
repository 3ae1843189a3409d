"""Toxicity by a classifier chain: linear models of hashed words, each later one also fed the earlier probabilities.

The chain's categories are label columns in order. Its models are fitted on at most ``sample`` labelled documents (those
of smallest id hash, so reruns agree). Words and word beginnings of five bytes are hashed features; the ``per_label``
features most associated with each category are chosen by counts over the sample. A later model is trained on the
earlier one's out-of-fold logits, as the earlier model would be overconfident on its own training rows. The cut of each
category is the one with the best F1 out of fold. Every document is then scored whole, in one pass without a shuffle.

Bounds: ``sample`` labelled documents, and of them ``per_label`` features a category that occur in five or more; rarer
words never count.

Cases: a null or empty text has no features and is never rejected; documents without label don't teach, one that lacks
some of the labels teaches the others; of repeated labels or ids each joined row teaches; a category with one class only,
or too few rows, gets a constant model and rejects nothing. Other columns are kept by ``without_toxic``; ``score_toxicity`` returns the id and the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.session import stage

HEAD = 5
FOLDS = 5
STEP = 1024  # rows of the sample worked on at once
SALT = np.uint64(0x5851F42D4C957F2D)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once."""
    ws = W.of_texts(texts, W.ALNUM)
    heads = W.Words(ws.data, ws.starts, np.minimum(ws.ends, ws.starts + HEAD), ws.ptr)
    doc = np.repeat(np.arange(len(texts)), np.diff(ws.ptr))
    found = np.concatenate([ws.hashes(), heads.hashes() ^ SALT])
    doc = np.concatenate([doc, doc])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return doc[new], found[new]


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.pieces(batches, "text"):
        doc, found = features(batch.column("text"))
        offsets = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64)))], [*others, "features"])


def fit_logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic model on some rows of x, whose last column is the intercept's; some rows at a time."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        slope, curve = -penalty * w, np.diag(penalty)
        for at in range(0, len(rows), STEP):
            some = rows[at : at + STEP]
            part = x[some].astype(np.float64)
            p = sigmoid(part @ w)
            slope = slope + part.T @ (y[some] - p)
            curve = curve + (part * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ part
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


@dataclass
class Chain:
    categories: tuple[str, ...]
    chosen: np.ndarray  # sorted feature hashes
    weights: list[np.ndarray | None]  # of the features, the earlier logits and the intercept
    cuts: list[float]
    out_of_fold: dict[str, tuple[np.ndarray, np.ndarray]]

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        doc, found = features(texts)
        at = np.minimum(np.searchsorted(self.chosen, found), max(len(self.chosen) - 1, 0))
        known = self.chosen[at] == found if len(self.chosen) else np.zeros(len(found), bool)
        doc, at = doc[known], at[known]
        logits: list[np.ndarray] = []
        for w in self.weights:
            if w is None:
                logits.append(np.full(len(texts), -35.0))
                continue
            n = len(self.chosen)
            z = np.bincount(doc, w[at], len(texts)) + w[-1]
            for k, earlier in enumerate(logits):
                z = z + w[n + k] * earlier
            logits.append(z)
        return np.array([sigmoid(z) for z in logits])


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, int], *, doc_id: str = "doc_id", text: str = "text", sample: int = 10000, per_label: int = 256) -> Chain:
    """``categories`` maps label columns, in chain order, to the value that counts as positive."""
    names = tuple(categories)
    ys = [f"y{k}" for k in range(len(names))]
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), *[(F.col(f"`{c}`") == v).cast("int").alias(y) for y, (c, v) in zip(ys, categories.items())]).dropna(how="all", subset=ys)
    picked = known.orderBy(F.xxhash64(F.lit("chain"), "id"), "id").limit(sample)  # at most ``sample`` ids are broadcast
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(stage(picked, "chain-labels")), "id")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    table = stage(rows.mapInArrow(feature_rows, f"{kinds}, features array<bigint>"), "chain-features")
    counts = table.select(F.explode("features").alias("f"), *ys).groupBy("f").agg(*[F.count(y).alias(f"n{y}") for y in ys], *[F.sum(y).alias(y) for y in ys])
    totals = table.agg(*[F.count(y) for y in ys], *[F.sum(y) for y in ys]).first()
    chosen: set[int] = set()
    for k, y in enumerate(ys):
        n, positive = totals[k], totals[len(ys) + k] or 0
        if positive < FOLDS or n - positive < FOLDS:
            continue
        share = F.col(f"n{y}") / n
        score = F.abs(F.col(y) / positive - (F.col(f"n{y}") - F.col(y)) / (n - positive)) / F.sqrt(share * (1 - share) + 1e-9)
        chosen |= {r[0] for r in counts.where(F.col(f"n{y}") >= 5).orderBy(score.desc(), "f").limit(per_label).select("f").collect()}
    features_ = np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))
    asked = F.array(*[F.lit(int(f)) for f in features_.view(np.int64)]) if len(features_) else F.array().cast("array<bigint>")
    held = F.array_sort(F.array_intersect("features", asked))
    found = table.select(F.xxhash64("id", held, *ys).alias("order"), held.alias("f"), *ys).toArrow()  # at most ``sample`` rows of at most 2 * per_label numbers
    found = found.take(np.argsort(found.column("order").to_numpy(), kind="stable"))
    size = np.diff(np.append(0, np.cumsum(pc.list_value_length(found.column("f")).to_numpy())))
    x = np.zeros((found.num_rows, len(features_) + len(names) + 1), np.float32)  # features, earlier logits, intercept
    x[:, -1] = 1
    flat = np.concatenate([c.flatten().to_numpy() for c in found.column("f").chunks]) if found.num_rows else np.zeros(0, np.int64)
    x[np.repeat(np.arange(found.num_rows), size), np.searchsorted(features_, flat.view(np.uint64))] = 1
    fold = np.arange(found.num_rows) % FOLDS
    weights: list[np.ndarray | None] = []
    cuts: list[float] = []
    out_of_fold: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for k, name in enumerate(names):
        column = found.column(ys[k])
        own = np.flatnonzero(column.is_valid().to_numpy())  # a category is learned from the rows that have its label
        y = pc.fill_null(column, 0).to_numpy().astype(float)
        earlier = len(features_) + k
        if y[own].sum() < FOLDS or len(own) - y[own].sum() < FOLDS:
            weights.append(None)
            cuts.append(2.0)
            x[:, earlier] = -35
            continue
        logit = np.zeros(len(y))
        used = np.delete(np.arange(x.shape[1]), np.arange(earlier, len(features_) + len(names)))
        for f in range(FOLDS):
            w = fit_logistic(x[:, used], y, own[fold[own] != f])
            logit[fold == f] = x[fold == f][:, used] @ w
        weights.append(fit_logistic(x[:, used], y, own))
        out_of_fold[name] = (sigmoid(logit[own]), y[own])
        cuts.append(best_cut(*out_of_fold[name]))
        x[:, earlier] = np.clip(logit, -35, 35)
    return Chain(names, features_, weights, cuts, out_of_fold)


def score_toxicity(docs: DataFrame, chain: Chain, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, p_<category> for each of the chain, and rejected (the last category's probability is above its cut)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text"):
            p = chain.probabilities(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v) for v in p], pa.array(p[-1] >= chain.cuts[-1])], ["doc_id", *names, "rejected"])

    names = [f"p_{c}" for c in chain.categories]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def without_toxic(docs: DataFrame, chain: Chain, *, text: str = "text") -> DataFrame:
    """The documents that the last category doesn't reject, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, text):
            yield batch.filter(pa.array(chain.probabilities(batch.column(text))[-1] < chain.cuts[-1]))

    return docs.mapInArrow(run, docs.schema)
