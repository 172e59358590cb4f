import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm import quality
from paperloom.llm.queries import op1_quality_classifier


def test_sum_of_squares_equals_all_pairs():
    draw = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.3, draw.normal(size=quality.FEATURES), draw.normal(size=(quality.FEATURES, 3)))
    x = quality.features(pa.array(["a b a c", None, "", "%%% !! x"]), pa.array([7, None, 0, 8]))
    margins, _ = model.margins(x)
    for row, (a, b) in enumerate(zip(x.starts(), x.ends)):
        index, value = x.index[a:b], x.value[a:b]
        want = 0.3 + (model.weights[index] * value).sum()
        for i in range(len(index)):
            for j in range(i):
                want += model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j]
        assert abs(margins[row] - want) < 1e-9


def test_held_out_accuracy(spark):
    scored = op1_quality_classifier(spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert scored.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()


def junk_and_prose(count):
    draw = random.Random(5)
    for i in range(count):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(draw.randint(5, 60))]
        yield (i, " ".join(words) + ".", 1) if i % 2 else (i, " ".join(w + "$$$" for w in words), 0)


def test_scores_ignore_labels_and_ids_and_cover_all_rows(spark, docs):
    data = list(junk_and_prose(200))
    labels = spark.createDataFrame([(i, q) for i, _, q in data] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs([(i, t) for i, t, _ in data]), labels)
    rows = [(1000, data[0][1]), (1001, data[1][1]), (0, data[1][1]), (7, None), (8, ""), (9, "x " * 200_000), (None, "a b"), (9, "dup"), (9, "dup")]
    frame = docs(rows).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    found = quality.with_score(frame, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "score"]
    scores = [(r.doc_id, r.text, r.score) for r in found.collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for _, _, s in scores)
    by_id = {i: s for i, t, s in scores}
    assert by_id[1000] < 0.3 < by_id[1001] == by_id[0]


def test_training_takes_any_further_columns_and_repeated_ids(spark, docs):
    data = list(junk_and_prose(120))
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    plain = quality.train(docs([(i, t) for i, t, _ in data]), labels)
    clash = docs([(i, t) for i, t, _ in data] * 3 + [(None, "x")]).withColumns({n: F.lit("z") for n in ("label", "quality", "rank", "stated", "row", "held", "index")})
    again = quality.train(clash, labels)
    assert again.bias == plain.bias and (again.weights == plain.weights).all() and (again.factors == plain.factors).all()


def test_the_fit_is_bounded_in_features(spark, docs, monkeypatch):
    data = list(junk_and_prose(60))
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(x.index)))
    frame = docs([(i, t + " more words" * 500) for i, t, _ in data])
    for most in (10**9, 900, 0):
        quality.train(frame, labels, fit_values=most)
    assert len(seen) == 2 and 0 < seen[1] <= 900 < seen[0]


def test_no_labels_and_no_documents(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs([(1, "a")]), empty)
    assert [r.score for r in quality.with_score(docs([(1, "a")]), model).collect()] == [0.5]
    assert quality.with_score(docs([]), model).count() == 0


@pytest.mark.parametrize("held", [0, 5])
def test_held_out_ids(spark, held):
    import zlib

    ids = [held, 12, 77, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in rows] == [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]
