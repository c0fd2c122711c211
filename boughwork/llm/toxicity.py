"""Toxicity by non-negative positive-unlabelled learning over hashed words and word beginnings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import low, one_text, settle, votes
from boughwork.llm.words import Adam, Rows, normal_words, parts, sigmoid


@dataclass
class Model:
    """Of buckets as :class:`boughwork.llm.words.Parts` numbers them, words first.

    A bucket's value in a text is how often it occurs there times its ``idf``; the margin is
    the bias and the weighted sum of the values, over the length of the vector of those of
    whole words. Long and short texts so weigh alike, and a word that no example holds
    lengthens the vector only. A text without words has the margin of the class prior.
    """

    bits: int
    empty: float
    bias: float
    weights: np.ndarray
    idf: np.ndarray
    _known: dict[bytes, complex] = field(default_factory=dict, repr=False)

    def _of(self, word: bytes) -> complex:
        """What the word adds to the sum, and to the square of the length, each time."""
        if len(self._known) >= 200_000:
            self._known.clear()
        own = list(parts(self.bits)[word])
        found = self._known[word] = complex(float(self.weights[own] @ self.idf[own]), float(self.idf[own[0]]) ** 2)
        return found

    def margin(self, text: str | None) -> float:
        own = Counter(normal_words(text))
        if not own:
            return self.empty
        known = self._known
        each = np.array([known.get(w) or self._of(w) for w in own])
        times = np.fromiter(own.values(), np.float64, len(own))
        return self.bias + float(each.real @ times) / float(np.sqrt(each.imag @ times**2))


def non_negative_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The risk to descend and its gradients by margin, with the logistic loss.

    Risk: prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]). Where the second
    part, the risk on negatives, falls below zero (the model has begun to fit the unlabelled
    examples one by one), only that part is followed, upwards.
    """
    p, u = sigmoid(positive), sigmoid(unlabelled)
    as_positive = prior * np.logaddexp(0, -positive).mean()
    as_negative = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
    by_u, by_p = u / len(u), -prior * p / len(p)  # of as_negative
    if as_negative < 0:
        return as_positive, -by_p, -by_u
    return as_positive + as_negative, prior * (p - 1) / len(p) + by_p, by_u


Example = tuple[np.ndarray, np.ndarray]  #: buckets of a text and how often each occurs


def fit(positive: list[Example], unlabelled: list[Example], prior: float, bits: int, steps: int = 200, rate: float = 0.3, least_docs: int = 8, decay: float = 1e-5) -> Model:
    """A linear model of words and word beginnings, the mean of the second half of the steps.

    Buckets of fewer than ``least_docs`` examples have no weight. The risk fixes how examples
    rank, but with some hundred confirmed examples hardly the level, so the bias is set last:
    the share of unlabelled examples above a margin of zero is the prior. Without positive or
    unlabelled examples every score is the prior.
    """
    size, empty = 2 << bits, float(np.log(prior / (1 - prior)))
    weights = np.zeros(size, np.float32)
    if not positive or not unlabelled:
        return Model(bits, empty, empty, weights, np.ones(size, np.float32))

    def seen(examples: list[Example]) -> np.ndarray:
        return sum(np.bincount(np.concatenate([c for c, _ in examples[i : i + 500]]), minlength=size) for i in range(0, len(examples), 500))

    in_unlabelled = seen(unlabelled)
    known = np.flatnonzero(in_unlabelled + seen(positive) >= least_docs)
    idf = np.log1p(len(unlabelled) / (1 + in_unlabelled)).astype(np.float32)
    place = np.full(size, -1)
    place[known] = np.arange(len(known))

    def rows(examples: list[Example]) -> Rows:
        columns, values = [], []
        for bucket, times in examples:
            value = times * idf[bucket]
            value /= max(1e-9, float(np.sqrt((value[bucket < 1 << bits] ** 2).sum())))
            kept = place[bucket] >= 0
            columns.append(place[bucket[kept]])
            values.append(value[kept].astype(np.float32))
        return Rows(columns, values)

    p, u = rows(positive), rows(unlabelled)
    w, adam = np.r_[np.zeros(len(known)), empty], Adam(len(known) + 1, rate)
    mean, half = np.zeros(len(w)), steps // 2
    for step in range(steps):
        _, by_p, by_u = non_negative_risk(p.dot(w[:-1]) + w[-1], u.dot(w[:-1]) + w[-1], prior)
        gradient = p.back(by_p, len(known)) + u.back(by_u, len(known)) + decay * w[:-1]
        w += adam.step(np.r_[gradient, by_p.sum() + by_u.sum()])
        if step >= half:
            mean += w / (steps - half)
    weights[known] = mean[:-1]
    return Model(bits, empty, -float(np.quantile(u.dot(mean[:-1]), 1 - prior)), weights, idf)


def _examples(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parts(bits).counts(normal_words(t)) for t in batch.column(2).to_pylist()]
            buckets = pa.array([c.astype("<i4").tobytes() for c, _ in found], pa.binary())
            times = pa.array([np.minimum(n, 65535).astype("<u2").tobytes() for _, n in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], buckets, times], ["positive", "unlabelled", "buckets", "times"])

    return run


def train(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, max_positive: int = 2500, max_unlabelled: int = 6000, bits: int = 20) -> Model:
    """Fit on documents confirmed as 1 and on unlabelled text, both outside the held-out fold.

    The unlabelled text is drawn from all documents with an id outside the fold, whether
    anybody labelled them or not, and a confirmed document may be among them. The class prior
    is the share of 1 among the labelled documents outside the fold, kept within 0.001 and
    0.5; so the labelled documents should be a fair sample in that respect.

    The samples are bounded: about ``max_positive`` and ``max_unlabelled`` documents, of which
    only bucket numbers and counts (up to 65535) reach the driver, a partition at a time.
    """
    own = votes(labels, label, held_out)
    judged, confirmed = own.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = float(min(0.5, max(0.001, confirmed / max(1, judged))))
    chosen = own.where((F.col("label") == 1) & low(max_positive, confirmed, "doc_id")).select("doc_id", F.lit(True).alias("positive"))
    rows = docs.where(F.col("doc_id").isNotNull() & ~held_out).select(F.col("doc_id").cast("long"), "text")
    rows = rows.withColumn("unlabelled", low(max_unlabelled, rows.count(), "doc_id")).join(F.broadcast(chosen), "doc_id", "left")
    rows = rows.withColumn("positive", F.coalesce("positive", F.lit(False))).where("positive or unlabelled")
    found = one_text(rows, "positive", "unlabelled").select("positive", "unlabelled", "text")
    found = settle(found.mapInArrow(_examples(bits), "positive boolean, unlabelled boolean, buckets binary, times binary"), "examples")
    positive, unlabelled = [], []
    for row in sorted(found.toLocalIterator(), key=lambda r: bytes(r["buckets"])):  # training doesn't depend on the order of tasks
        example = np.frombuffer(row["buckets"], "<i4"), np.frombuffer(row["times"], "<u2")
        if row["positive"]:
            positive.append(example)
        if row["unlabelled"]:
            unlabelled.append(example)
    return fit(positive, unlabelled, prior, bits)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of each whole text; null and empty texts, and
    others without words, that of the class prior."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            margins = np.array([own.margin(t) for t in batch.column(len(keep)).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sigmoid(margins))], [*keep, "score"])

    schema = docs.select(*keep).schema.add("score", "double")
    return docs.select(*keep, "text").mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic") -> DataFrame:
    """``(doc_id, score, predicted)`` for each row of ``docs`` (doc_id, text).

    Only words are inputs. predicted is 1 from a score of 0.5. Each row is scored on its own,
    so repeated rows, several texts of a doc_id (of which the one of the smallest hash may
    train), null ids and extra columns are fine; an empty table gives no rows.
    """
    scored = score(docs.select(F.col("doc_id").cast("long"), "text"), train(docs, labels, label, held_out), ["doc_id"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
