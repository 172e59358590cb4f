from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm import shards


@pytest.mark.parametrize(("pool", "marked", "draws"), [(20, 7, 9), (20, 20, 5), (20, 0, 5), (8, 3, 8), (8, 3, 0), (0, 0, 0), (1000, 500, 100)])
def test_hypergeometric_counts_follow_the_distribution(spark, pool, marked, draws):
    steps = 4000
    uniform = (F.col("id") + 0.5) / steps
    value = shards.hypergeometric(*[F.lit(x).cast("bigint") for x in (pool, marked, draws)], uniform)
    got = Counter(r.x for r in spark.range(steps).select(value.alias("x")).collect())
    total = comb(pool, draws)
    for x in set(got) | set(range(draws + 1)):
        chance = comb(marked, x) * comb(pool - marked, draws - x) / total if x <= marked and draws - x <= pool - marked else 0
        assert abs(got.get(x, 0) - steps * chance) <= 2


def test_matrix_has_the_sizes_as_sums(spark):
    sizes = [(p, n) for p, n in enumerate([5, 0, 1, 700, 40, 40, 3, 211])]
    rows = shards.communication_matrix(spark.createDataFrame(sizes, "part long, n long"), 8, 1000, 24, 1).collect()
    assert {r.part: sum(r.counts) for r in rows} == dict(sizes)
    assert [sum(r.counts[s] for r in rows) for s in range(24)] == [1000 // 24 + (s < 1000 % 24) for s in range(24)]
    assert all(c >= 0 for r in rows for c in r.counts)


@pytest.mark.parametrize("slot_rows", [1_000_000, 7])
def test_every_row_gets_one_slot(docs, monkeypatch, slot_rows):
    monkeypatch.setattr(shards, "SLOT_ROWS", slot_rows)
    rows = [(i, "same") for i in range(90)] + [(None, None), (None, None), (3, ""), (3, "x" * 100_000)]
    frame = docs(rows, 5).withColumns({"shard": F.lit("x"), "part": F.lit(1), "counts": F.lit(2)})
    found = shards.shuffle_to_shards(frame, 4)
    got = found.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(94 // 4 + (s < 94 % 4)))
    assert got[0].part == 1


def test_shuffle_is_uniform(spark):
    """Each row is as likely in each shard: five seeds, 60 rows, 3 shards."""
    rows = spark.range(60).repartition(4)
    seen = Counter()
    for seed in range(5):
        for r in shards.shuffle_to_shards(rows, 3, seed).collect():
            seen[r.id, r.shard] += 1
    chi = sum((seen[i, s] - 5 / 3) ** 2 / (5 / 3) for i in range(60) for s in range(3))
    assert 60 < chi < 190  # 120 degrees of freedom


def test_few_rows_and_none(docs):
    assert sorted((r.shard, r.slot) for r in shards.shuffle_to_shards(docs([(1, "a"), (2, "b")]), 5).collect()) == [(0, 0), (1, 0)]
    assert shards.shuffle_to_shards(docs([]), 5).count() == 0


def test_plan_has_no_python(docs):
    plan = shards.shuffle_to_shards(docs([(1, "a")]), 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
