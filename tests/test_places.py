"""Country extraction against a plain scan, and the ordered lists of articles."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.operators import places, rollup
from paperloom.operators.lookup import attach, lookup, measured_bytes
from paperloom.operators.places import Gazetteers

COUNTRIES = {n: n for n in ["France", "Kenya", "Peru", "Niger", "Nigeria", "United Kingdom"]}
COUNTRIES["UK"] = "United Kingdom"
CITIES = [
    ("Paris", "Paris, France"), ("York", "York, UK"), ("New York", "NY, Nowhere"),
    ("Saint-Denis", "Saint-Denis, France"), ("Lima", "Lima, Peru"), ("Lima Norte", "Lima, Peru"),
]
PLACES = [("Campus 5", "x, Kenya"), ("the old site", "Peru"), ("no man", "nothing")]


@pytest.fixture(params=[1 << 25, 0], ids=["broadcast", "shuffled"])
def known(request, spark):
    return Gazetteers(
        COUNTRIES,
        spark.createDataFrame(CITIES, "city string, address string"),
        spark.createDataFrame(PLACES, "place string, address string"),
        broadcast_bytes=request.param,
    )


def scan(text, names):
    """Leftmost-longest whole-word matches, one character at a time."""
    found, at = [], 0
    while at < len(text):
        best = None
        for name in names:
            end = at + len(name)
            inside = (at > 0 and re.match(r"\w", text[at - 1])) or (
                end < len(text) and re.match(r"\w", text[end])
            )
            if text.startswith(name, at) and not inside:
                best = max(best or "", name, key=len)
        found += [best] if best else []
        at += len(best) if best else 1
    return found


def test_extraction_equals_a_plain_scan(spark, known):
    pick = random.Random(7)
    pieces = [c for c, _ in CITIES] + ["New", "Norte", "x", "Parisian", "de", "Saint", "-Denis"]
    texts = sorted(
        {pick.choice(["", " "]).join(pick.choices(pieces, k=6)) for _ in range(200)}
        | {" , ".join(pick.choices(pieces, k=9)) for _ in range(200)}
        | {" ".join(pick.choices(pieces, k=40)) for _ in range(20)}
    )
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = places.extract_cities(frame, "t", known)
    got = {r.t: [m.city for m in r.mentions] for r in found.collect()}
    names = [c for c, _ in CITIES]
    assert got == {t: scan(t, names) for t in texts if scan(t, names)}


RESOLVED = [
    ("Dept, Nigeria and Niger, Nigeria", ["Nigeria", "Niger"]),
    ("Uni of Paris, then York", ["United Kingdom"]),
    ("Paris, York, Paris", ["United Kingdom"]),
    ("Lab 3, New York", [None]),
    ("Lima Norte", ["Peru"]),
    ("at Campus 5", ["Kenya"]),
    ("Campus 5", ["Kenya"]),
    ("the old site", ["Peru"]),
    ("see the old site", [None]),
    ("no man", [None]),
    ("Somewhere", [None]),
    ("", [None]),
    (None, [None]),
]


def test_countries_of_texts(spark, known):
    frame = spark.createDataFrame([(t,) for t, _ in RESOLVED] * 3, "t string")
    rows = places.countries_of_texts(frame, "t", known).collect()
    assert len(rows) == 3 * len(RESOLVED)
    wanted = dict(RESOLVED)
    assert all(r.countries == wanted[r.t] for r in rows)


def test_without_fallback_tables(spark):
    frame = spark.createDataFrame([("x Peru",), ("Paris",)], "t string")
    rows = places.countries_of_texts(frame, "t", Gazetteers(COUNTRIES)).collect()
    assert [r.countries for r in rows] == [["Peru"], [None]]


ARTICLES = [
    (1, 1, ["x Peru", "x Peru", "Paris"], ["Peru", "Peru", "France"]),
    (2, 1, ["Somewhere", "Niger and Peru"], [None, "Niger", "Peru"]),
    (3, 1, None, [None]),
    (4, 1, [], None),
    (5, 0, ["x Peru"], None),
    (6, None, ["x Peru"], None),
    (7, 1, ["Kenya"], ["Kenya"]),
    (7, 1, ["Lima"], ["Peru"]),
    (7, 1, ["Lima"], ["Peru"]),
    (None, 1, ["Lima"], ["Peru"]),
    (None, 1, ["Paris", None], ["France", None]),
]


def test_countries_of_articles(spark, known):
    frame = spark.createDataFrame(
        [a[:3] for a in ARTICLES], "pmid int, include int, author_affils array<string>"
    )
    rows = places.countries_of_articles(frame, known, F.col("include") == 1).collect()
    order = lambda r: str(r)
    got = sorted([(r.pmid, r.include, r.author_affils, r.affil_countries) for r in rows], key=order)
    assert got == sorted([tuple(a) for a in ARTICLES], key=order)


def test_cities_that_begin_with_no_word(spark):
    cities = spark.createDataFrame([("'s-Hage", "x, Kenya"), ("", "none")], "city string, address string")
    frame = spark.createDataFrame([("in 's-Hage",), ("Hage",)], "t string")
    rows = places.countries_of_texts(frame, "t", Gazetteers(COUNTRIES, cities)).collect()
    assert {r.t: r.countries for r in rows} == {"in 's-Hage": ["Kenya"], "Hage": [None]}


def test_the_batch_is_read_once_and_the_pattern_runs_once(spark, known, tmp_path):
    rows = [a[:3] for a in ARTICLES if a[0]]
    frame = spark.createDataFrame(rows, "pmid int, include int, author_affils array<string>")
    frame.write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    placed = places.countries_of_articles(batch, known, F.col("include") == 1)
    shown = placed._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path) not in shown and "LocalRelation" not in shown.split("Relation")[0]
    assert shown.count("regexp_extract_all(lambda") == 0
    assert placed.count() == len(rows)


def test_a_hot_tail_beyond_the_broadcast_limit(spark):
    cities = spark.createDataFrame(CITIES, "city string, address string")
    far = spark.createDataFrame(PLACES, "place string, address string")
    hot = Gazetteers(COUNTRIES, cities, far, broadcast_bytes=0)
    frame = spark.range(4000).select(F.concat(F.lit("Room "), F.col("id"), F.lit(" at Campus 5")).alias("t"))
    rows = places.countries_of_texts(frame, "t", hot)
    assert rows.where("countries[0] = 'Kenya'").count() == 4000
    assert "explode(sequence" not in rows._jdf.queryExecution().toString()


def test_list_columns_and_rendering(spark):
    frame = spark.createDataFrame(
        [(1, ["Peru", None, "Peru"]), (2, [None]), (3, None), (4, [None, "Chad"])],
        "pmid int, affil_countries array<string>",
    )
    rows = {r.pmid: r[1:] for r in rollup.rendered(rollup.list_columns(frame)).collect()}
    assert rows == {
        1: ("['Peru', nan, 'Peru']", "['Peru', nan]", "Peru", "Peru"),
        2: (None, None, None, None),
        3: (None, None, None, None),
        4: ("[nan, 'Chad']", "['Chad', nan]", None, "Chad"),
    }


def test_rollups_do_not_depend_on_partitioning(spark):
    pick = random.Random(3)
    rows = [(k, p, pick.choice(["A", "B", "C", None])) for k in range(5) for p in range(200 if k == 0 else 3)]
    expected = {}
    for key, _, country in sorted(rows, key=lambda r: r[:2]):
        expected.setdefault(key, []).append(country)
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "pmid int, pos int, country string")
    for parts, salts in ((1, 1), (7, 8), (3, 1000)):
        split = frame.repartition(parts)
        lists = {r.pmid: r for r in rollup.rollup_lists(split, "pmid", ["pos"], salts=salts).collect()}
        short = {r.pmid: r for r in rollup.rollup_summary(split, "pmid", ["pos"]).collect()}
        assert {k: r.affil_countries for k, r in lists.items()} == expected
        for key, values in expected.items():
            for row in (lists[key], short[key]):
                assert row.affil_first_country == values[0]
                assert row.affil_last_country == values[-1]
                assert set(row.affil_countries_unique) == set(values)
            assert lists[key].affil_countries_unique == short[key].affil_countries_unique


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_paths_agree(spark, how):
    facts = spark.createDataFrame([(k % 7 if k % 5 else None, k) for k in range(100)], "k int, v int")
    table = spark.createDataFrame([(k, f"name {k}") for k in range(5)], "k int, name string")
    small = sorted(map(str, lookup(facts, table, "k", how).collect()))
    large = sorted(map(str, lookup(facts, table, "k", how, limit_bytes=0).collect()))
    derived = sorted(map(str, attach(facts, table, "k", how).collect()))
    assert small == large == derived
    assert measured_bytes(table) > 0


@pytest.mark.parametrize(
    "hot, join",
    [
        (0, lambda facts, table: lookup(facts, table, "k", limit_bytes=0, salts=16)),
        (None, lambda facts, table: lookup(facts, table, "k", limit_bytes=0, salts=16)),
        (None, lambda facts, table: attach(facts, table, "k")),
        (None, lambda facts, table: attach(facts, table.select("k"), "k", "left_anti")),
    ],
)
def test_shuffled_joins_split_a_hot_key(spark, hot, join):
    """A third of the rows share one key or none; no task of the join gets them all."""
    facts = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("long").alias("k"), "id"
    )
    table = spark.range(30000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join(facts, table)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    total = sum(r["count"] for r in sizes)
    assert total == (10000 if "id" in joined.columns and len(joined.columns) == 2 else 30000)
    assert max(r["count"] for r in sizes) < total / 4
