"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, their first few bytes (inflected and compound forms share them), pairs of neighbours and
pairs with one word between are hashed to a fixed number of coordinates; each counts once a text.  Every coordinate has its own learning rate, and the L1 part
keeps all but the telling ones at exactly zero, so the weights that go to the tasks are small.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.storage import brought_back, set_aside
from estatelens.llm.textbytes import (PUNCTUATION, combine, give_back, running_hash, span_hashes,
                                      text_slices, word_spans)
from estatelens.llm.tokens import release_chunks


@dataclass(frozen=True)
class ToxicityParams:
    """``max_labelled``: most labelled rows used for fitting (the lowest by a hash of doc_id);
    ``learner_rows``: rows of one learner, whose weights are averaged; ``bits``: coordinates as a
    power of two; ``prefixes``: lengths of word beginnings in bytes; the rest are the usual
    FTRL-proximal constants."""

    max_labelled: int = 20_000
    learner_rows: int = 5_000
    bits: int = 20
    prefixes: tuple[int, ...] = (5, 6, 7)
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0
    threshold: float = 0.5


def text_features(data: np.ndarray, offsets: np.ndarray, params: ToxicityParams) -> tuple:
    """Row and coordinate of every n-gram and skip-gram occurrence in a slice of texts."""
    starts, ends, firsts = word_spans(data, offsets, PUNCTUATION)
    total = running_hash(data)
    words = span_hashes(total, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    rows, hashes = [row], [combine([words], 1)]
    for gap in (1, 2):
        same = row[gap:] == row[:-gap]
        rows.append(row[gap:][same])
        hashes.append(combine([words[:-gap][same], words[gap:][same]], 1 + gap))
    for size in params.prefixes:
        longer = np.flatnonzero(ends - starts > size)
        rows.append(row[longer])
        begins = span_hashes(total, starts[longer], starts[longer] + size)
        hashes.append(combine([begins], 10 + size))
    at = (np.concatenate(hashes) >> np.uint64(64 - params.bits)).astype(np.int64)
    return np.concatenate(rows), at


class Ftrl:
    """The learner; coordinate ``2**bits`` is the intercept, free of L1."""

    def __init__(self, params: ToxicityParams):
        self.p, size = params, (1 << params.bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.l1 = np.full(size, params.l1)
        self.l1[-1] = 0.0

    def weights(self, at) -> np.ndarray:
        z, p = self.z[at], self.p
        shrunk = np.maximum(np.abs(z) - self.l1[at], 0.0) * np.sign(z)
        return -shrunk / ((p.beta + np.sqrt(self.n[at])) / p.alpha + p.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha * w
        self.n[at] = n + g * g


def _labelled(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """Text and label of the sample; never rows whose crc32(doc_id) is divisible by 5."""
    known = (labels.where("toxic in (0, 1) and crc32(cast(doc_id as string)) % 5 <> 0")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id")
             .limit(params.max_labelled))
    # the sample's size is a parameter, so it may be sent to every task
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def fit_toxicity(docs: DataFrame, labels: DataFrame,
                 params: ToxicityParams = ToxicityParams()) -> np.ndarray:
    """Weights by coordinate, the intercept last; zeros but for the intercept without labels."""
    schema = "at int, weight double, rows long"

    def learn(batches):
        release_chunks()
        examples = []
        for batch in batches:
            labels_ = batch.column(0).to_pylist()
            for first, data, offsets in text_slices(batch.column(1)):
                rows, at = text_features(data, offsets, params)
                order = np.argsort(rows, kind="stable")
                begin = np.searchsorted(rows[order], np.arange(len(offsets)))
                at = at[order].astype(np.int32)
                for i in range(len(offsets) - 1):
                    own = np.unique(at[begin[i]:begin[i + 1]])
                    own = np.append(own, np.int32(1 << params.bits))
                    examples.append((own, labels_[first + i]))
        if not examples:
            return
        learner = Ftrl(params)
        for epoch in range(params.epochs):
            for i in np.random.default_rng(epoch).permutation(len(examples)):
                learner.learn(*examples[i])
        learned = len(examples)
        examples.clear()
        weights = learner.weights(slice(None))
        del learner
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(weights[at]),
             pa.array(np.full(len(at), learned))], ["at", "weight", "rows"])
        give_back()

    sample = _labelled(docs, labels, params)
    learners = max(1, -(-params.max_labelled // params.learner_rows))
    known = labels.where("toxic in (0, 1)").limit(params.max_labelled).count()
    learners = min(learners, max(1, -(-known // params.learner_rows)))
    parts = (sample.repartition(learners, "order").sortWithinPartitions("order", "doc_id")
             .select("toxic", "text").mapInArrow(learn, schema))
    out = np.zeros((1 << params.bits) + 1)
    out[-1] = -20.0
    # at most ``learners`` sets of ``2**bits`` coordinates, both parameters
    found = parts.toArrow()
    if found.num_rows:
        at, rows = found.column("at").to_numpy(), found.column("rows").to_numpy()
        intercepts = at == 1 << params.bits
        share = rows / max(1, rows[intercepts].sum())
        out[:] = np.bincount(at, found.column("weight").to_numpy() * share, len(out))
    return out


def score_texts(docs: DataFrame, weights: np.ndarray, params: ToxicityParams, score: str,
                keep: list[str]) -> DataFrame:
    """``keep`` columns and the score of each whole text, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    held = docs.select(*keep, F.col("text").alias("_text"))
    schema = held.select(*keep).schema.add(score, "double")
    names = [f.name for f in schema]

    def scores(batches):
        release_chunks()
        w = shared.value
        for batch in batches:
            out = []
            for _, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                rows, at = text_features(data, offsets, params)
                telling = np.flatnonzero(w[at])
                pairs = np.unique((rows[telling] << params.bits) | at[telling])
                own, at = pairs >> params.bits, pairs & ((1 << params.bits) - 1)
                total = np.bincount(own, w[at], len(offsets) - 1) + float(w[-1])
                out.append(1.0 / (1.0 + np.exp(-np.clip(total, -500, 500))))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(np.concatenate(out))], names)
            del batch
            give_back()

    return held.mapInArrow(scores, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame,
                    params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text, ...)``.

    The score depends on the text alone; NULL and empty texts get the intercept's.  Rows are
    returned one for one, repeated rows and rows without doc_id (never held out) included.  Several
    labels of one doc_id count as the highest; without usable labels every score is near 0.
    Other columns of either table are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weights = fit_toxicity(docs, labels.select("doc_id", "toxic"), params)
    scored = score_texts(docs, weights, params, "score", ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
        .alias("held_out"), "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame,
               params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns kept, whatever their
    names."""
    weights = fit_toxicity(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                           labels.select("doc_id", "toxic"), params)
    rows = score_texts(set_aside(docs, ["text"]), weights, params, "score", ["text", "others"])
    return brought_back(rows.where(F.col("score") < params.threshold), docs.columns, ["text"])
