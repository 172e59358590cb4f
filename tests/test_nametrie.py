import random
import regex

import pytest
from pyspark.sql import functions as F

from paperloom.functions.text import WORD
from paperloom.operators import nametrie

ATOM = regex.compile(f"[{WORD}]+|[^{WORD}]", regex.S)


def brute(text, names):
    cut, known = ATOM.findall(text), {tuple(ATOM.findall(n)) for n in names if n}
    longest, at, out = max(map(len, known), default=0), 0, []
    while at < len(cut):
        size = next((k for k in range(longest, 0, -1) if tuple(cut[at : at + k]) in known and at + k <= len(cut)), 0)
        if size:
            out.append("".join(cut[at : at + size]))
        at += size or 1
    return out


def table(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_walk_equals_brute_force(spark, limit):
    draw = random.Random(2)
    parts = ["New", "York", "San", "a", "b", " ", "-", "#", "1", "é"]
    names = sorted({"".join(draw.choices(parts, k=draw.randint(1, 5))) for _ in range(60)}) + [None, ""]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(150)] + [None, "", "x" * 100_000, "New " * 3000]
    rows = nametrie.find_names(table(spark, texts + texts[:5], "t"), "t", table(spark, names, "n"), "n", limit).collect()
    found = {r.t: r.mentions for r in rows}
    assert len(found) == len(rows)
    for text in texts:
        want = brute(text, names) if text else []
        assert found.get(text, []) == want, text


def test_words_are_whole_and_the_longest_name_wins(spark):
    names = table(spark, ["York", "New York", "New York City", "Supplier#1", "City Hall"], "name")
    texts = table(spark, ["New York City Hall", "NewYork, York's Yorkshire", "Supplier#12 Supplier#1", "new york"], "t")
    found = {r.t: r.mentions for r in nametrie.find_names(texts, "t", names, "name").collect()}
    assert found == {"New York City Hall": ["New York City"], "NewYork, York's Yorkshire": ["York"], "Supplier#12 Supplier#1": ["Supplier#1"]}


def test_nothing_to_find(spark):
    names = table(spark, ["a"], "n")
    for texts, known in ((names.limit(0), names), (names, names.limit(0)), (names, table(spark, [None, ""], "n"))):
        found = nametrie.find_names(texts, "n", known, "n")
        assert found.columns == ["n", "mentions"] and found.count() == 0


def test_the_trie_has_one_row_per_edge(spark):
    edges = nametrie.name_trie(table(spark, ["a b", "a c", "a", "a b"], "n"), "n").collect()
    assert sorted((e.depth, e.before, e.word, e.is_name) for e in edges) == [(0, "", "a", True), (1, "a", " ", False), (2, "a ", "b", True), (2, "a ", "c", True)]


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_names_longer_than_a_stretch_of_levels(spark, limit):
    draw, words = random.Random(4), ["a", "b", " "]
    long = ["".join(draw.choices(words, k=draw.randint(8, 20))) for _ in range(12)]
    names = sorted({*long, "a", "b a", *[n[: len(n) // 2] for n in long]} - {""})
    texts = sorted({draw.choice(long) + " " + draw.choice(long)[:-1] for _ in range(40)})
    assert max(len(ATOM.findall(n)) for n in names) > nametrie.LEVELS
    rows = nametrie.find_names(table(spark, texts, "t"), "t", table(spark, names, "n"), "n", limit).collect()
    found = {r.t: r.mentions for r in rows}
    assert {t: found.get(t, []) for t in texts} == {t: brute(t, names) for t in texts}


def test_only_a_large_level_is_shuffled(spark):
    names = table(spark, [f"Customer#{i}" for i in range(3000)], "n")
    texts = table(spark, [f"from Customer#{i}, Customer#x" for i in range(0, 6000, 1000)], "t")
    frame = nametrie.find_names(texts, "t", names, "n", 20_000)
    shown = frame._jdf.queryExecution().executedPlan().toString()
    # The first two levels have one edge each; words that all texts share would meet in one task.
    assert shown.count("BroadcastHashJoin") >= 2
    assert {r.t: r.mentions for r in frame.collect()} == {f"from Customer#{i}, Customer#x": [f"Customer#{i}"] for i in (0, 1000, 2000)}


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_rows_keep_their_mentions_without_moving_texts(spark, tmp_path, limit):
    draw = random.Random(3)
    parts, names = ["New", "York", "a", " ", "#", "1"], ["New York", "a", "York#1", "New York a"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(80)] + [None, ""]
    rows = [(i, text) for i, text in enumerate([*texts, *texts[:9], None, None])] + [(0, texts[0]), (None, "a New York"), (None, None)]
    spark.createDataFrame(rows, "n long, t string").write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows"))
    frame = nametrie.with_names(read, "t", table(spark, names, "name"), "name", limit_bytes=limit)
    shown = frame._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert frame.columns == ["n", "mentions"]
    want = [(i, brute(text, names) or None if text else None) for i, text in rows]
    assert sorted(map(str, want)) == sorted(str((r.n, r.mentions)) for r in frame.collect())
    # The texts were moved when their rows were numbered, and are not moved again.
    moved = [part for part in shown.split("\n\n") if "Arguments: hashpartitioning(" in part]
    assert moved and not any("hashpartitioning(t#" in part or "__text" in part or " text#" in part for part in moved)
    assert nametrie.with_names(frame.select("n", F.lit(None).cast("string").alias("t")), "t", table(spark, [""], "x"), "x").count() == len(rows)
