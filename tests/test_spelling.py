import random
import string

import pytest
from pyspark.sql import functions as F

from paperloom.operators import spelling


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def table(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def misspell(draw, name, edits):
    for _ in range(edits):
        at = draw.randrange(len(name) + 1)
        name = draw.choice([name[:at] + draw.choice("abcx") + name[at:], name[:at] + name[at + 1 :], name[:at] + draw.choice("abcx") + name[at + 1 :]])
    return name


def test_every_name_within_the_distance_is_found(spark):
    draw = random.Random(3)
    names = sorted({"".join(draw.choices("abc", k=draw.randint(1, 9))) for _ in range(120)})
    texts = sorted({misspell(draw, draw.choice(names), draw.randint(0, 4)) for _ in range(150)})
    found = {r.t: (r.name, r.distance, r.ties) for r in spelling.nearest_names(table(spark, texts, "t"), "t", table(spark, names, "n"), "n").collect()}
    for text in texts:
        near = [(distance(text, n), n) for n in names]
        least = min(near)[0]
        want = (min(near)[1], least, sum(d == least for d, _ in near)) if least <= 2 else None
        assert found.get(text) == want, text


def test_case_accents_and_blanks_cost_nothing(spark):
    names = table(spark, ["São Tomé", "Zürich  West", "Łódź", None, ""], "n")
    texts = ["sao tome", " ZURICH west ", "Sâo  Tomè", "zurixh wst", "Lodz", None]
    rows = spelling.nearest_names(table(spark, texts, "t").union(table(spark, texts, "t")), "t", names, "n").collect()
    found = {r.t: (r.name, r.distance) for r in rows}
    assert len(rows) == len(found) == 5
    assert found[" ZURICH west "] == ("Zürich  West", 0) and found["zurixh wst"] == ("Zürich  West", 2)
    assert found["sao tome"] == found["Sâo  Tomè"] == ("São Tomé", 0)
    # A stroke is no accent, so this letter differs.
    assert found["Lodz"] == ("Łódź", 1)


@pytest.mark.parametrize("text", ["", "a", "ab", "aab", string.ascii_lowercase])
def test_deletions(spark, text):
    forms = spark.range(1).select(spelling.deletions(F.lit(text), 2).alias("f")).first().f
    want = {text}
    for _ in range(2):
        want |= {w[:i] + w[i + 1 :] for w in want for i in range(len(w))}
    assert sorted(forms) == sorted(want)


def test_nothing_to_look_up(spark):
    names, none = table(spark, ["a"], "n"), table(spark, ["a"], "n").limit(0)
    assert spelling.nearest_names(none, "n", names, "n").count() == 0
    assert spelling.nearest_names(names, "n", none, "n").count() == 0


def test_names_meet_by_equality_only(spark):
    frame = spelling.nearest_names(table(spark, ["ab"], "t"), "t", table(spark, ["abc"], "n"), "n")
    shown = frame._jdf.queryExecution().toString()
    assert "CartesianProduct" not in shown and "NestedLoopJoin" not in shown and "Python" not in shown


def test_no_task_gets_all_forms(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TASK_FORMS", 500)
    names = [f"Institute {i:03d}" for i in range(40)]
    known = table(spark, names, "n")
    count = spelling._form_count(known, "n", 2)
    assert count == 40 * (1 + 13 + 78)
    forms = spelling._forms(known, "n", 2, -(-count // 500))
    assert forms.rdd.getNumPartitions() == 8
    assert forms.rdd.glom().map(len).max() < 2000
    found = spelling.nearest_names(table(spark, [n.replace("tut", "tu") for n in names], "t"), "t", known, "n").collect()
    assert sorted((r.name, r.distance) for r in found) == [(n, 1) for n in names]
