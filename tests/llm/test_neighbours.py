import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from paperloom.llm import neighbours
from paperloom.llm.queries import op8_collision_counting


def brute(rows, wanted, k=5):
    out = set()
    good = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    for q in wanted:
        if q in good:
            scored = [(-(good[q] @ v) / np.sqrt((v @ v) * (good[q] @ good[q])), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
            out |= {(q, rank, i) for rank, (_, i) in enumerate(sorted((round(s, 12), i) for s, i in scored)[:k], 1)}
    return out


def test_recall_over_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    got = {(r.query_id, r.vec_id) for r in op8_collision_counting(spark, MEDIUM).collect()}
    assert len({(q, i) for q, _, i in want} & got) >= 0.95 * len(want)


@pytest.mark.parametrize(("vectors", "queries"), [(16_384, 65_536), (40, 10)])
def test_all_kinds_of_rows(spark, monkeypatch, vectors, queries):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", vectors)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", queries)
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(120)]
    rows += [(i, rows[i - 200][1]) for i in range(200, 203)]  # ties
    rows += [(300, None), (301, [0.0] * 6), (302, [1.0, None] + [0.0] * 4), (303, [float("nan")] * 6), (304, [float("inf")] + [1.0] * 5)]
    rows += [(305, []), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (None, [1.0] * 6), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    wanted = [0, 1, 2, 50, 200, 300, 301, 303, 305, 306]
    found = neighbours.nearest_vectors(frame, frame.where(F.col("vec_id").isin(wanted))).collect()
    got, want = {(r.query_id, r["rank"], r.vec_id) for r in found}, brute(rows, wanted)
    assert len(found) == len(got) == len(want)
    assert len(got & want) >= 0.97 * len(want)
    assert {(306, 1, 307), (0, 1, 200), (200, 1, 0)} <= got


def test_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest_vectors(none, none).count() == 0
