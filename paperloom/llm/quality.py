"""Quality scores from a factorisation machine.

Features are hashed words, bins of structure statistics, and bins of the stated length as
metadata. The score is the logistic of ``bias + sum(w x) + pairs``; the pairwise part, the sum of
``<v_i, v_j> x_i x_j`` over all pairs, is half of ``(sum v x)^2 - sum (v x)^2`` summed over the
factors, which takes time linear in the number of features.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from paperloom.llm.shared import share
from paperloom.llm.text import Words, slices
from paperloom.session import work_folder

#: Hashed words; bins of each statistic.
WORD_BUCKETS = 1 << 14
BINS = 24
FACTORS = 8
#: The most labelled rows a fit takes: those with the smallest hash of their id.
FIT_ROWS = 6000
#: The most features of these rows that come to the driver, 16 bytes each.
FIT_VALUES = 12_000_000
#: Steps of a fit, each over ``BATCH`` rows, however many rows there are.
STEPS, BATCH = 800, 256
THRESHOLD = 0.3
_STATS = 12
FEATURES = WORD_BUCKETS + _STATS * BINS

_CLASS = {name: np.zeros(256, dtype=np.int64) for name in ("upper", "digit", "symbol", "letter")}
_CLASS["upper"][65:91] = 1
_CLASS["digit"][48:58] = 1
_CLASS["letter"][[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS["symbol"][[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,"]] = 1


@dataclass
class Features:
    """Sparse rows: the features of row i are at ``ends[i-1]`` to ``ends[i]``."""

    index: np.ndarray
    value: np.ndarray
    ends: np.ndarray

    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1]))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.clip((BINS - 1) * np.sqrt(part / np.maximum(whole, 1)), 0, BINS - 1).astype(np.int64)


def _size(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(count + 1.0), BINS - 1).astype(np.int64)


def features(texts: pa.Array, stated: pa.Array) -> Features:
    """The features of whole texts and their stated lengths; NULL texts count as empty."""
    words = Words(texts)
    rows, counts, owner, hashes = words.texts, words.counts(), words.text_of(), words.hashes()
    bucket = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    pairs, times = np.unique(owner * WORD_BUCKETS + bucket, return_counts=True)
    row, word = pairs // WORD_BUCKETS, pairs % WORD_BUCKETS
    weight = np.log1p(times)
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=rows))
    weight = weight / norm[row]

    def inside(name: str) -> np.ndarray:
        """Bytes of the class inside words, by text."""
        running = np.concatenate(([0], np.cumsum(_CLASS[name][words.data])))
        return np.bincount(owner, running[words.ends] - running[words.starts], minlength=rows)

    lengths = words.ends - words.starts
    size = np.bincount(owner, lengths, minlength=rows)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    letters = np.concatenate(([0], np.cumsum(_CLASS["letter"][words.data])))
    bare = letters[words.ends] == letters[words.starts]
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, row, times)
    distinct = np.bincount(row, minlength=rows)
    long_words = np.bincount(owner, lengths >= 20, minlength=rows)
    missing = pc.is_null(stated).to_numpy(zero_copy_only=False)
    told = pc.fill_null(stated.cast(pa.float64()), 0).to_numpy(zero_copy_only=False)
    stats = [
        _size(counts),
        _size(8 * size / np.maximum(counts, 1)),
        _share(inside("upper"), size),
        _share(inside("digit"), size),
        _share(inside("symbol"), size),
        _share(np.bincount(owner, same, minlength=rows), counts),
        _share(np.bincount(owner, bare, minlength=rows), counts),
        _share(top, counts),
        _share(distinct, counts),
        _share(long_words, counts),
        np.where(missing, BINS - 1, _size(np.maximum(told, 0))),
        np.where(missing, BINS - 1, _size(8 * np.maximum(told, 0) / np.maximum(counts, 1))),
    ]
    bins = WORD_BUCKETS + np.stack(stats, axis=1) + BINS * np.arange(_STATS)
    order = np.argsort(np.concatenate((row, np.repeat(np.arange(rows), _STATS))), kind="stable")
    index = np.concatenate((word, bins.ravel()))[order]
    value = np.concatenate((weight, np.full(rows * _STATS, 0.5)))[order]
    return Features(index, value, np.cumsum(distinct + _STATS))


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, x: Features) -> tuple[np.ndarray, np.ndarray]:
        """The raw scores, and for each row the sum of v x, which the gradient needs as well."""
        starts = x.starts()
        scaled = self.factors[x.index] * x.value[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(scaled * scaled, starts, axis=0)
        linear = np.add.reduceat(self.weights[x.index] * x.value, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def scores(self, x: Features) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x)[0], -500, 500)))


def fit(x: Features, labels: np.ndarray, steps: int = STEPS, rate: float = 0.02, decay: float = 1e-4) -> FactorisationMachine:
    """Logistic loss, Adam, fixed order and seed."""
    random = np.random.default_rng(7)
    model = FactorisationMachine(0.0, np.zeros(FEATURES), random.normal(0, 0.01, (FEATURES, FACTORS)))
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.factors)]
    starts, ends, step = x.starts(), x.ends, 0
    while step < steps:
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            sizes = ends[rows] - starts[rows]
            take = np.arange(sizes.sum()) + np.repeat(starts[rows] - np.cumsum(sizes) + sizes, sizes)
            part = Features(x.index[take], x.value[take], np.cumsum(sizes))
            raw, sums = model.margins(part)
            error = (1.0 / (1.0 + np.exp(-np.clip(raw, -500, 500))) - labels[rows]) / len(rows)
            pull = np.repeat(error, sizes) * part.value
            rest = np.repeat(sums, sizes, axis=0) - model.factors[part.index] * part.value[:, None]
            grads = [np.bincount(part.index, pull, minlength=FEATURES), np.zeros_like(model.factors)]
            np.add.at(grads[1], part.index, pull[:, None] * rest)
            step += 1
            for p, g, (m, s) in zip((model.weights, model.factors), grads, state):
                g += decay * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            model.bias -= rate * float(error.sum())
    return model


def held_out(id_column: Column) -> Column:
    """The fifth of the ids that no fit may use; false for a NULL id, which has no label either."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            x = features(part.column("text"), part.column("stated"))
            ends = pa.array(np.concatenate(([0], x.ends)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in (x.index.astype(np.int32), x.value)]
            own = [part.column(n) for n in ("rank", "label")]
            yield pa.RecordBatch.from_arrays([*own, *lists], ["rank", "label", "index", "value"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label: str = "quality",
    text: str = "text",
    stated: str = "n_chars",
    fit_rows: int = FIT_ROWS,
    fit_values: int = FIT_VALUES,
) -> FactorisationMachine:
    """Fit on labelled documents outside the held-out fifth.

    At most ``fit_rows`` of them: the ones whose ids hash smallest, a random sample that does
    not depend on partitions, and of these as many as hold ``fit_values`` features together. Only
    their features come to the driver. Of rows that repeat an id one is taken. NULL ids and labels
    are left out; without any labelled row the model says one half. Other columns, whatever their
    names, are not looked at.
    """
    key = F.col(id_column)
    usable = labels.select(key.alias("__id"), F.col(label).cast("double").alias("label")).dropna()
    usable = usable.where(~held_out(F.col("__id"))).withColumn("rank", F.xxhash64("__id"))
    chosen = usable.orderBy("rank", "label").limit(fit_rows)
    own = docs.select(key.alias("__id"), F.col(text).alias("text"), F.col(stated).cast("long").alias("stated"))
    joined = own.join(F.broadcast(chosen), "__id")
    one = F.min(F.struct(F.xxhash64("text", "stated").alias("h"), "text", "stated", "rank")).alias("row")
    rows = joined.groupBy("__id", "label").agg(one).select("row.text", "row.stated", "row.rank", "label")
    folder = work_folder(docs.sparkSession, "fit")
    rows.mapInArrow(_measured, "rank long, label double, index array<int>, value array<double>").write.parquet(folder)
    stored = docs.sparkSession.read.parquet(folder)
    # At most ``fit_rows`` sizes are put in order.
    order = Window.orderBy("rank", "label", F.xxhash64("index", "value"))
    held = F.sum(F.size("index")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    table = stored.withColumn("held", held).where(F.col("held") <= fit_values).select("label", "index", "value").toArrow()
    if not table.num_rows:
        return FactorisationMachine(0.0, np.zeros(FEATURES), np.zeros((FEATURES, FACTORS)))
    y = table.column("label").to_numpy()
    index, value = (table.column(n).combine_chunks() for n in ("index", "value"))
    del table
    sizes = pc.list_value_length(index).to_numpy()
    index, value, ends = index.flatten().to_numpy(), value.flatten().to_numpy(), np.cumsum(sizes)
    # Rows come in no fixed order; sorting them makes the fit repeatable.
    digest = index + 1.0
    digest *= value
    digest = np.add.reduceat(digest, ends - sizes)
    order = np.lexsort((digest, sizes, y))
    take = np.concatenate([np.arange(ends[i] - sizes[i], ends[i], dtype=np.int32) for i in order])
    chosen_rows = Features(index[take], value[take], np.cumsum(sizes[order]))
    del index, value, digest, take
    pa.default_memory_pool().release_unused()
    return fit(chosen_rows, y[order])


def with_score(
    docs: DataFrame,
    model: FactorisationMachine,
    text: str = "text",
    stated: str = "n_chars",
    score: str = "score",
) -> DataFrame:
    """The documents with a quality score between 0 and 1; higher means label 1 is likelier.

    Every row gets a score from its whole text and its stated length, empty and NULL texts
    too. Ids, labels, language and source are not looked at. Other columns are kept; one named
    like the score is replaced.
    """
    docs = docs.drop(score)
    shared = share(docs.sparkSession, model)
    names = docs.columns

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared()
        for batch in batches:
            for part in slices(batch, text):
                told = part.column(stated).cast(pa.int64())
                scores = machine.scores(features(part.column(text), told))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*names, score])

    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    return docs.mapInArrow(rate, schema)
