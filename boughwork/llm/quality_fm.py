"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boughwork.llm.common import labelled
from boughwork.llm.words import NORMAL, buckets, sigmoid

_SYMBOLS = b"#*$%&|<>{}[]\\^~_=+@"
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_STOPS = b".,;:?"
_HIGH = bytes(range(0x80, 0x100))
#: Number of statistics that :func:`structure` gives.
STRUCTURE = 14


def structure(text: str) -> np.ndarray:
    """Statistics of the shape of a text, in its bytes."""
    data = text.encode("utf-8")
    size = max(1, len(data))

    def share(kind: bytes) -> float:
        return (len(data) - len(data.translate(None, kind))) / size

    tokens = data.split()
    n = max(1, len(tokens))
    lines = [x for x in data.split(b"\n") if x.strip()]
    triples = list(zip(tokens, tokens[1:], tokens[2:]))
    upper, lower = share(_UPPER), share(_LOWER)
    return np.array(
        [
            np.log1p(len(tokens)),
            len(data) / n,
            share(_SYMBOLS),
            upper / max(1e-9, upper + lower),
            share(_DIGITS),
            share(_HIGH),
            share(b"!"),
            share(_STOPS),
            1 - len(set(lines)) / max(1, len(lines)),
            len(set(tokens)) / n,
            1 - len(set(triples)) / max(1, len(triples)),
            np.log1p(len(tokens) / max(1, len(lines))),
            share(b"|"),
            sum(map(bytes.isdigit, tokens)) / n,
        ]
    )


@dataclass
class Model:
    """Weights by feature: word buckets first, then the structure statistics."""

    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def margins(self, columns: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        """Rows in linear time: pairs by the square of sums less the sum of squares."""
        if not columns:
            return np.zeros(0)
        starts = np.r_[0, np.cumsum([len(c) for c in columns])[:-1]]
        column, value = np.concatenate(columns), np.concatenate(values)
        scaled = self.factors[column] * value[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(scaled * scaled, starts, axis=0)
        return self.bias + np.add.reduceat(self.linear[column] * value, starts) + 0.5 * (sums**2 - squares).sum(axis=1)

    def rows(self, texts: Sequence[str | None], metadata: Sequence[Sequence]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        raw = [features(t, m, self.bits) for t, m in zip(texts, metadata)]
        return [c for c, _ in raw], [self.scale(v) for _, v in raw]

    def scale(self, value: np.ndarray) -> np.ndarray:
        out = value.copy()
        out[-STRUCTURE:] = np.clip((out[-STRUCTURE:] - self.mean) / self.spread, -4, 4) / np.sqrt(STRUCTURE)
        return out


def features(text: str | None, metadata: Sequence, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values): words as log counts of length one in all, metadata, structure."""
    text = text or ""
    words = text.encode("utf-8").translate(NORMAL).split()
    words += [f"\x00{i}={m}".encode() for i, m in enumerate(metadata)]
    column, count = buckets(bits).counts(words)
    value = np.log1p(count)
    value /= max(1e-9, np.sqrt((value**2).sum()))
    return np.r_[column, (1 << bits) + np.arange(STRUCTURE)], np.r_[value, structure(text)]


def fit(columns: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, bits: int, rank: int = 8, epochs: int = 12, batch: int = 128, rate: float = 0.08, decay: float = 1e-4, least_docs: int = 3, seed: int = 5) -> Model:
    """Adagrad on the logistic loss. Without examples of both labels every score is the share of 1."""
    size = (1 << bits) + STRUCTURE
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    rng = np.random.default_rng(seed)
    model = Model(bits, float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, rank), np.float32), np.zeros(STRUCTURE), np.ones(STRUCTURE))
    if len(set(labels.tolist())) < 2:
        return model
    stats = np.array([v[-STRUCTURE:] for v in values])
    model.mean, model.spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    values = [model.scale(v) for v in values]
    seen = np.bincount(np.concatenate(columns), minlength=size) >= least_docs
    kept = [seen[c] for c in columns]
    columns, values = [c[k] for c, k in zip(columns, kept)], [v[k] for v, k in zip(values, kept)]
    known = np.flatnonzero(seen)
    place = np.zeros(size, np.int64)
    place[known] = np.arange(len(known))
    columns = [place[c] for c in columns]
    linear, factors = np.zeros(len(known)), rng.normal(0, 0.05, (len(known), rank))
    linear_sum, factor_sum, bias_sum, bias = np.full(len(known), 1e-6), np.full((len(known), rank), 1e-6), 1e-6, model.bias
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(columns[i]) for i in chosen])
            starts, row = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(chosen)), sizes)
            column, value = np.concatenate([columns[i] for i in chosen]), np.concatenate([values[i] for i in chosen])
            scaled = factors[column] * value[:, None]
            sums = np.add.reduceat(scaled, starts, axis=0)
            pairs = 0.5 * (sums**2 - np.add.reduceat(scaled**2, starts, axis=0)).sum(axis=1)
            margin = bias + np.add.reduceat(linear[column] * value, starts) + pairs
            slope = (sigmoid(margin) - labels[chosen]) / len(chosen)
            by_entry = slope[row] * value
            own, at_own = np.unique(column, return_inverse=True)
            g = np.bincount(at_own, by_entry, len(own)) + decay * linear[own]
            step = by_entry[:, None] * (sums[row] - scaled)
            gv = np.stack([np.bincount(at_own, step[:, f], len(own)) for f in range(rank)], axis=1) + decay * factors[own]
            linear_sum[own] += g**2
            factor_sum[own] += gv**2
            bias_sum += slope.sum() ** 2
            linear[own] -= rate * g / np.sqrt(linear_sum[own])
            factors[own] -= rate / 4 * gv / np.sqrt(factor_sum[own])
            bias -= rate * slope.sum() / np.sqrt(bias_sum)
    model.bias, model.linear[known], model.factors[known] = float(bias), linear, factors
    return model


def _named(metadata: Sequence[Column]) -> dict[str, Column]:
    return {f"metadata{i}": m.cast("string") for i, m in enumerate(metadata)}


def size_of(docs: DataFrame) -> list[Column]:
    """Metadata of documents: the power of two that their ``n_chars`` reaches, if they have it."""
    return [F.floor(F.log2(F.greatest(F.col("n_chars").cast("double"), F.lit(1.0))))] if "n_chars" in docs.columns else []


def train(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, metadata: Sequence[Column] = (), max_labelled: int = 6000, bits: int = 17) -> Model:
    """Fit on about ``max_labelled`` documents labelled outside the held-out fold; their
    features, not their texts, reach the driver. ``metadata`` are expressions over ``docs``,
    whose values count as words; of several rows of a doc_id those of the chosen text's."""
    named = _named(metadata)
    chosen = labelled(docs, labels, label, held_out, max_labelled, named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, own, *more = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            found = [features(t, m, bits) for t, m in zip(text, zip(*more) if more else [()] * len(text))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array([c.astype("<i4").tobytes() for c, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                ["label", "columns", "amounts"],
            )

    rows = chosen.select("text", "label", *named).mapInArrow(run, "label int, columns binary, amounts binary").collect()
    rows.sort(key=lambda r: bytes(r["columns"]))  # training doesn't depend on the order of tasks
    columns = [np.frombuffer(r["columns"], "<i4").astype(np.int64) for r in rows]
    return fit(columns, [np.frombuffer(r["amounts"], "<f4").astype(np.float64) for r in rows], np.array([r["label"] for r in rows], np.float64), bits)


def score(docs: DataFrame, model: Model, keep: list[str], metadata: Sequence[Column] = ()) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of each whole text; null texts count as empty."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            text, *more = (batch.column(i).to_pylist() for i in range(n, batch.num_columns))
            margins = [own.margins(*own.rows(text[i : i + 200], [*zip(*more)][i : i + 200] if more else [()] * len(text[i : i + 200]))) for i in range(0, len(text), 200)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(sigmoid(np.concatenate([*margins, np.zeros(0)])))], [*keep, "score"])

    schema = docs.select(*keep).schema.add("score", "double")
    return docs.select(*keep, "text", *(c.alias(n) for n, c in _named(metadata).items())).mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", threshold: float = 0.7, keep: Sequence[str] = ("doc_id",), metadata: Sequence[Column] | None = None) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` (1 from ``threshold``) for each row of ``docs``.

    The inputs of a score are the text's words and shape, and ``metadata``, by default
    :func:`size_of`. Repeated rows, null ids and extra columns are fine; an empty table gives
    no rows.
    """
    metadata = size_of(docs) if metadata is None else metadata
    scored = score(docs, train(docs, labels, label, held_out, metadata), list(keep), metadata)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns as they were.

    Rows are judged where they lie, each on its own, so null ids, repeated rows and columns
    of any name are fine; an empty table gives no rows.
    """
    metadata = size_of(docs)
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, held_out, metadata))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                text, *more = (part.column(k).to_pylist() for k in range(1, part.num_columns))
                margins = own.margins(*own.rows(text, [*zip(*more)] if more else [()] * part.num_rows))
                yield part.select([0]).filter(pa.array(sigmoid(margins) >= threshold))

    rows = docs.select(F.struct("*").alias("row"), "text", *(c.alias(n) for n, c in _named(metadata).items()))
    return rows.mapInArrow(run, StructType([rows.schema["row"]])).select("row.*")
