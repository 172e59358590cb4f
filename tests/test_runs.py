import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from paperloom.operators import quality, runs


def brute(flags):
    out, at = [], 0
    for failed, group in groupby(flags):
        size = len(list(group))
        if failed:
            out.append((at, at + size - 1, size))
        at += size
    return out


def table(spark, flags, parts=5):
    rows = [(i, f) for i, f in enumerate(flags)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "place int, bad boolean").repartition(parts)


@pytest.mark.parametrize("bits", [(13, 8), (2, 1), (0, 1)])
@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_runs_equal_brute_force(spark, monkeypatch, bits, share):
    monkeypatch.setattr(runs, "CHUNK_BITS", bits[0])
    monkeypatch.setattr(runs, "FAN_BITS", bits[1])
    draw = random.Random(f"{share}")
    flags = [draw.random() < share for _ in range(120)]
    ids = runs.numbered(table(spark, flags), ["place"], F.col("bad"))
    want = brute(flags)
    summary = runs.run_summary(ids)
    first = next((i for i, f in enumerate(flags) if not f), len(flags))
    last = next((i for i, f in enumerate(flags[::-1]) if not f), len(flags))
    assert summary == {"length": 120, "prefix": first, "suffix": last, "longest": max((n for *_, n in want), default=0)}
    found = sorted((r["first"].place, r["last"].place, r["length"]) for r in runs.failure_runs(ids, ["place"], 2).collect())
    assert found == [w for w in want if w[2] >= 2]


def test_nulls_and_no_rows(spark):
    frame = spark.createDataFrame([(1, None), (2, True), (None, True), (3, True)], "place int, bad boolean")
    ids = runs.numbered(frame, ["place"], F.col("bad"))
    assert runs.run_summary(ids) == {"length": 4, "prefix": 1, "suffix": 2, "longest": 2}
    none = runs.numbered(frame.limit(0), ["place"], F.col("bad"))
    assert runs.run_summary(none)["longest"] == 0 and runs.failure_runs(none, ["place"], 1).count() == 0


def test_gate_looks_at_the_order_not_at_the_ratio(spark):
    scattered = table(spark, [i % 3 == 0 for i in range(90)])
    assert runs.consecutive_gate(scattered, ["place"], F.col("bad"), 5)["longest"] == 1
    together = table(spark, [40 <= i < 45 for i in range(90)])
    runs.consecutive_gate(together, ["place"], F.col("bad"), 6)
    with pytest.raises(quality.TooManyFailures, match="one after the other"):
        runs.consecutive_gate(together, ["place"], F.col("bad"), 5)
