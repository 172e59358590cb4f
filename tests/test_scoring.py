import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import scoring

TEXTS = [
    (1, "That that HEIT", True),
    (2, None, True),
    (3, "nothing", True),
    (4, "thatthat", False),
    (5, "heit heit that", None),
]
MODEL = scoring.TermModel({"that": 1.0, "heit": -1.5}, 0.5)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(TEXTS, "pmid int, feature string, wanted boolean")


def labels(frame, name="label"):
    return {r.pmid: r[name] for r in frame.collect()}


def test_native_and_batch_scores_agree(frame):
    native = scoring.score_binary(frame, "label", MODEL, where=F.col("wanted"))
    batches = scoring.score_binary(frame, "label", scoring.loaded(MODEL), where=F.col("wanted"))
    assert labels(native) == labels(batches) == {1: 1.0, 2: None, 3: 1.0, 4: None, 5: None}


def test_exact_half_rounds_to_even(spark):
    frame = spark.createDataFrame([(0.0,), (1e-9,), (0.5,), (1.5,), (2.5,)], "x double")
    rows = frame.select(
        scoring.rounded_label(F.col("x"), True).alias("p"),
        scoring.rounded_label(F.col("x"), False).alias("r"),
    ).collect()
    assert [r.p for r in rows[:2]] == [0.0, 1.0]
    assert [r.r for r in rows] == [0.0, 0.0, 0.0, 2.0, 2.0]


def test_model_sees_batches_of_the_given_size_and_wanted_rows_only(spark):
    frame = spark.range(0, 250, 1, 1).select(
        F.col("id").alias("pmid"), F.concat(F.lit("t"), "id").alias("feature")
    )

    def load():
        def model(texts):
            assert len(texts) <= 100 and all(int(t[1:]) >= 120 for t in texts)
            return np.array([int(t[1:]) for t in texts], dtype=float)

        return model

    rows = scoring.score_binary(
        frame, "label", load, where=F.col("pmid") >= 120, logit=False, batch=100
    ).collect()
    assert all(r.label == (r.pmid if r.pmid >= 120 else None) for r in rows)


def test_multilabel_spreads_one_call_over_all_labels(frame):
    model = scoring.TermLabels(["that", "heit"], [[1, 0], [0, 1], [-1, 0]], [0, -0.5, 0.5])
    rows = scoring.score_multilabel(
        frame, scoring.loaded(model), ["a", "b", "c"], where=F.col("wanted")
    )
    got = {r.pmid: (r.a, r.b, r.c) for r in rows.collect()}
    missing = (None, None, None)
    assert got == {1: (1, 1, 0), 2: missing, 3: (0, 0, 1), 4: missing, 5: missing}


def test_multilabel_refuses_a_wrong_number_of_outputs(frame):
    model = scoring.TermLabels(["that"], [[1], [1]], [0, 0])
    with pytest.raises(Exception, match="reshape"):
        scoring.score_multilabel(frame, scoring.loaded(model), ["a", "b", "c"]).collect()


def test_write_back(spark, frame):
    scores = spark.createDataFrame([(1, 1.0, 1), (3, 0.0, 1)], "pmid int, include double, x int")
    filled = scoring.write_back(frame, scores, "pmid", ["include"])
    assert labels(filled, "include") == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    plain = scoring.write_back(frame, scores, "pmid", ["include"], fill_zero=False)
    assert labels(plain, "include") == {1: 1.0, 2: None, 3: 0.0, 4: None, 5: None}
