"""Batch scoring of article texts with pluggable models."""

import math
import re
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.constants import CHARACTERISTICS, SCORING_BATCH
from paperloom.operators.lookup import lookup

Model = Callable[[np.ndarray], np.ndarray]

# Sent with each scoring function, so that executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class TermModel:
    """A linear model: weighted counts of terms in the lower-cased text, plus a bias."""

    weights: Mapping[str, float]
    bias: float = 0.0

    def column(self, text: Column) -> Column:
        """The raw score as built-in expressions, for scoring inside the JVM."""
        lowered = F.lower(text)
        total = F.lit(float(self.bias))
        for term, weight in self.weights.items():
            hits = F.regexp_count(lowered, F.lit(_literal(term)))
            total = total + hits * F.lit(float(weight))
        return total

    def __call__(self, texts: np.ndarray) -> np.ndarray:
        lowered = [text.lower() for text in texts]
        scores = np.full(len(lowered), float(self.bias))
        for term, weight in self.weights.items():
            scores += weight * np.array([text.count(term.lower()) for text in lowered], dtype=float)
        return scores


@dataclass(frozen=True)
class TermLabels:
    """A multi-label model: one weight per vocabulary term and label, as probabilities."""

    vocabulary: Sequence[str]
    weights: Sequence[Sequence[float]]
    biases: Sequence[float]

    def counts(self, text: Column) -> list[Column]:
        """How often each term occurs, as built-in expressions."""
        lowered = F.lower(text)
        return [F.regexp_count(lowered, F.lit(_literal(term))) for term in self.vocabulary]

    def columns(self, counts: Sequence[Column]) -> list[Column]:
        """Each label's probability from the counts."""
        scores = []
        for weights, bias in zip(self.weights, self.biases):
            parts = [n * F.lit(float(w)) for n, w in zip(counts, weights) if w]
            scores.append(sigmoid(sum(parts, counts[0] * 0.0 + F.lit(float(bias)))))
        return scores

    def __call__(self, texts: np.ndarray) -> np.ndarray:
        lowered = [text.lower() for text in texts]
        counts = np.array([[t.count(term.lower()) for term in self.vocabulary] for t in lowered], float)
        scores = counts @ np.array(self.weights, float).T + np.array(self.biases, float)
        return 1.0 / (1.0 + np.exp(-np.clip(scores, -700, 700)))


def loaded(model: Model) -> Callable[[], Model]:
    """A loader for a model small enough to travel with the task."""
    return lambda: model


def _literal(term: str) -> str:
    return re.escape(term.lower())


def sigmoid(score: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-score))


def rounded_label(score: Column, logit: bool) -> Column:
    """0/1 by rounding half to even, so a probability of exactly 0.5 gives 0."""
    return F.rint(sigmoid(score) if logit else score)


def batch_scores(load: Callable[[], Model], text: Column, outputs: int, batch: int) -> Column:
    """Raw model outputs for text batches; ``load`` runs once per Python worker.

    NULL texts never reach the model and score NaN.
    """

    def make_predict() -> Callable[[np.ndarray], np.ndarray]:
        model = load()

        def predict(texts: np.ndarray) -> np.ndarray:
            texts = np.asarray(texts, dtype=object).reshape(-1)
            known = np.array([isinstance(text, str) for text in texts], dtype=bool)
            result = np.full((len(texts), outputs), math.nan)
            if known.any():
                scores = np.asarray(model(texts[known]), dtype=float)
                result[known] = scores.reshape(int(known.sum()), outputs)
            return result if outputs > 1 else result[:, 0]

        return predict

    kind = T.DoubleType() if outputs == 1 else T.ArrayType(T.DoubleType())
    return predict_batch_udf(make_predict, return_type=kind, batch_size=batch)(text)


def score_binary(
    df: DataFrame,
    label: str,
    model: TermModel | Callable[[], Model],
    where: Column | None = None,
    logit: bool = True,
    feature: str = "feature",
    batch: int = SCORING_BATCH,
) -> DataFrame:
    """Add a 0/1 label where ``where`` holds and NULL elsewhere.

    A ``TermModel`` is scored inside the JVM. Anything else is a loader called in the
    Python workers, which get NULL instead of the text of rows that are not to be scored:
    the model sees only the wanted rows, in one pass and without a join.
    """
    wanted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    text = F.when(wanted, F.col(feature))
    if isinstance(model, TermModel):
        score = model.column(text)
    else:
        score = F.nanvl(batch_scores(model, text, 1, batch), F.lit(None).cast("double"))
    return df.withColumn(label, rounded_label(score, logit))


def score_multilabel(
    df: DataFrame,
    model: TermLabels | Callable[[], Model],
    labels: Sequence[str] = CHARACTERISTICS,
    where: Column | None = None,
    logit: bool = False,
    feature: str = "feature",
    batch: int = SCORING_BATCH,
) -> DataFrame:
    """Add all labels; rows outside ``where`` stay NULL.

    ``TermLabels`` are scored inside the JVM, each term being counted once per text. Anything
    else is a loader, whose model gives all labels in one call per batch.
    """
    wanted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    text = F.when(wanted, F.col(feature))
    if isinstance(model, TermLabels):
        names = [f"__count{i}" for i in range(len(model.vocabulary))]
        counted = df.select("*", *[c.alias(n) for c, n in zip(model.counts(text), names)])
        scores = model.columns([F.col(n) for n in names])
        return counted.select(
            *df.columns, *[rounded_label(s, logit).alias(name) for s, name in zip(scores, labels)]
        )
    scored = df.withColumn("__scores", batch_scores(model, text, len(labels), batch))
    missing = F.lit(None).cast("double")
    columns = [
        rounded_label(F.nanvl(F.get("__scores", F.lit(i)), missing), logit).alias(name)
        for i, name in enumerate(labels)
    ]
    return scored.select(*df.columns, *columns)


def write_back(
    df: DataFrame, scores: DataFrame, key: str, labels: Sequence[str], fill_zero: bool = True
) -> DataFrame:
    """Labels kept in another table, brought back by key; unscored rows get 0 or NULL.

    ``scores`` holds each key once. Where a model scores the rows in place no join is
    needed: see ``score_binary``.
    """
    joined = lookup(df, scores.select(key, *labels), key)
    if not fill_zero:
        return joined
    filled = {label: F.coalesce(F.col(label), F.lit(0)).cast("int") for label in labels}
    return joined.withColumns(filled)
