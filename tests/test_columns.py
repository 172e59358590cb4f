"""Scalar expressions, term lists, search, window, mark and flags on hand-made rows."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from paperloom import constants, schemas
from paperloom.functions import terms, text
from paperloom.operators import filters, rollup
from paperloom.sources import articles, gazetteers


def one(spark, column, value, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(column(F.col("v"))).first()[0]


def test_fixed_values():
    assert len(constants.CHARACTERISTICS) == len(set(constants.CHARACTERISTICS)) == 56
    assert len(constants.MAIN_COLUMNS) == len(set(constants.MAIN_COLUMNS)) == 84
    assert len(constants.LOWER_INCOME_TERMS) == 85
    assert len(constants.LOW_MIDDLE_INCOME_TERMS) == 143
    assert len(set(constants.LOW_MIDDLE_INCOME_TERMS)) == 142


@pytest.mark.parametrize(
    "title, abstract, expected",
    [("t", "a", "t a"), ("t", None, "t nan"), (None, None, "nan nan")],
)
def test_feature_text(spark, title, abstract, expected):
    frame = spark.createDataFrame([(title, abstract)], "t string, a string")
    assert frame.select(text.feature_text(F.col("t"), F.col("a"))).first()[0] == expected


@pytest.mark.parametrize(
    "items",
    [["A", "B"], [], ["it's"], ['say "x"'], ["both ' and \""], ["back\\slash"], [None, "A"]],
)
def test_render_list_reads_like_a_python_list(spark, items):
    shown = repr([float("nan") if i is None else i for i in items])
    assert one(spark, text.render_list, items, "array<string>") == shown


def test_blank_nan_list(spark):
    assert one(spark, text.blank_nan_list, "[nan]") is None
    assert one(spark, text.blank_nan_list, "[nan, nan]") == "[nan, nan]"


def test_minimal_terms_keep_containment():
    assert terms.minimal_terms(["niger", "nigeria", "mali", "somalia", "mali"]) == ["niger", "mali"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Dept, Niger and Nigeria; Niger", ["Niger", "Nigeria"]),
        ("Nigerian", []),
        ("in Guinea-Bissau", ["Guinea-Bissau"]),
        ("Papua New Guinea,Guinea", ["Papua New Guinea", "Guinea"]),
        ("x USA.", ["United States"]),
        ("usa", []),
        ("", []),
        (None, None),
    ],
)
def test_mentions(spark, value, expected):
    names = {n: n for n in ["Niger", "Nigeria", "Guinea", "Guinea-Bissau", "Papua New Guinea"]}
    names["USA"] = "United States"
    assert one(spark, lambda c: terms.mentions(c, names), value) == expected


def test_mentions_without_case(spark):
    found = one(spark, lambda c: terms.mentions(c, {"Peru": "Peru"}, False), "in PERU, peru")
    assert found == ["Peru"]


def test_country_names_come_with_the_platform_and_their_aliases(spark):
    names = gazetteers.country_spellings(spark)
    assert names["Nigeria"] == "Nigeria" and names["USA"] == "United States"
    assert names["Wales"] == "Wales" and names["Viet Nam"] == "Vietnam"
    assert len(names) > 250


def test_only_the_misspelt_income_term_cannot_be_hit(spark):
    canonical = {name.lower() for name in gazetteers.country_spellings(spark).values()}
    terms_ = dict.fromkeys(constants.LOW_MIDDLE_INCOME_TERMS)
    missed = [t for t in terms_ if not any(re.search(t, name) for name in canonical)]
    assert missed == ["palestinbe"]


def test_name_tables_of_any_size(spark):
    frame = spark.range(6000).select(F.col("id").cast("string").alias("n"))
    assert len(gazetteers.name_table(frame, "n")) == 6000


def test_best_address(spark):
    frame = spark.createDataFrame(
        [("Paris", "Paris, US", 2), ("Paris", "Paris, FR", 1), (None, "x", 1)],
        "city string, address string, rank int",
    )
    assert gazetteers.best_address(frame, "city", "rank").collect() == [("Paris", "Paris, FR")]


SEARCHED = [
    (1, "Deep Learning", None, None, True),
    (2, "learning is unsupervised", "", None, True),
    (3, "plain", "a NEURAL NETwork", None, True),
    (4, "plain", None, ["Artificial Intelligence"], True),
    (5, "plain learning", None, ["Humans", None], False),
    (6, None, None, None, False),
]


def test_search(spark):
    frame = spark.createDataFrame(
        [row[:4] for row in SEARCHED], "pmid int, title string, abstract string, mesh_terms array<string>"
    )
    hits = {r.pmid for r in articles.match_search(frame).collect()}
    assert hits == {row[0] for row in SEARCHED if row[4]}


def test_search_ignores_the_case_of_terms_and_empty_lists_match_nothing(spark):
    frame = spark.createDataFrame(
        [(1, "deep learning x", None, ["ai"]), (2, "other", "words", ["b"])],
        "pmid int, title string, abstract string, mesh_terms array<string>",
    )

    def hits(**query):
        empty = {"phrases": [], "all_words": [], "heading_terms": []}
        return {r.pmid for r in articles.match_search(frame, **{**empty, **query}).collect()}

    assert hits() == hits(phrases=[""]) == hits(all_words=[[]]) == set()
    assert hits(phrases=["Deep Learning"]) == hits(heading_terms=["AI"]) == {1}
    assert hits(all_words=[["WORDS", "Other"], ["deep", "none"]]) == {2}


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp"])
def test_date_window_includes_both_ends(spark, kind):
    moments = [datetime(2024, 1, d, h) for d in (1, 2, 3, 4) for h in (0, 23)]
    frame = spark.createDataFrame([(m,) for m in moments], "d timestamp_ntz").select(
        F.col("d").cast(kind).alias("d")
    )
    rows = articles.date_window(frame, "d", date(2024, 1, 2), date(2024, 1, 3)).count()
    assert rows == 4
    assert articles.date_window(frame, "d", None, None).count() == 8


def test_cap_reports_all_hits(spark):
    rows = articles.cap(spark.range(100), [F.col("id").desc()], 3).collect()
    assert rows == [(99, 100), (98, 100), (97, 100)]


def test_mark_of_an_empty_table_is_the_epoch(spark):
    empty = spark.createDataFrame([], "d date")
    assert articles.high_water_mark(empty, "d", date(2000, 1, 1)).first().mark == "2000/01/01"
    assert articles.mark_date(empty, "d") == date(1900, 1, 1)


@pytest.mark.parametrize(
    "subjects, kept",
    [(["Mice", "Humans"], False), (["Catheterization"], False), (["Humans", "mice"], True),
     (None, True), ([], True), ([None, "Humans"], True)],
)
def test_animal_filter(spark, subjects, kept):
    frame = spark.createDataFrame([(subjects,)], "mesh_terms array<string>")
    assert (filters.drop_by_term_prefix(frame).count() == 1) == kept
    assert filters.drop_by_term_prefix(frame, enabled=False).count() == 1


@pytest.mark.parametrize(
    "country, lmic, lower, compat",
    [("Nigeria", 1, 1, 0), ("Venezuela", 1, 0, 1), ("United Kingdom", 0, 0, 0), ("Iran", 1, 1, 1),
     ("China", 1, 0, 0), (None, 0, 0, 0), ("St. Vincent", 1, 0, 0), ("Somalia", 1, 1, 0)],
)
def test_flags(spark, country, lmic, lower, compat):
    rendered = None if country is None else f"['{country}']"
    frame = spark.createDataFrame([(rendered,)], "affil_countries_unique string")
    row = rollup.country_flags(frame).first()
    assert (row.lmic_author_flag, row.lmic_author_lower_flag) == (lmic, lower)
    assert row.lmic_china_flag == (1 if country == "China" else 0)
    old = rollup.country_flags(frame, lower_terms=constants.LOWER_INCOME_TERMS_COMPAT).first()
    assert old.lmic_author_lower_flag == compat


def test_null_text_leaves_flags_alone(spark):
    frame = spark.createDataFrame([(None,)], "affil_countries_unique string")
    nan, empty = rollup.country_flags(frame).first(), rollup.country_flags(frame, null_text="").first()
    assert (nan.countries_lc, empty.countries_lc) == ("nan", "")
    assert nan.asDict() | {"countries_lc": ""} == empty.asDict()


def test_substring_flags_cover_exact_ones(spark):
    names = [[t.title()] for t in constants.LOW_MIDDLE_INCOME_TERMS]
    names += [["Dominican Republic"], ["Somaliland"], [None]]
    wide = constants.LOW_MIDDLE_INCOME_TERMS
    frame = spark.createDataFrame([(n,) for n in names], "c array<string>")
    rows = frame.select(
        rollup.flag_any_term(F.lower(text.render_list(F.col("c"))), wide).alias("loose"),
        rollup.flag_any_term(F.col("c"), wide, "exact").alias("exact"),
    ).collect()
    assert all(r.loose >= r.exact for r in rows)
    assert sum(r.loose for r in rows) > sum(r.exact for r in rows)


def test_unknown_flag_mode(spark):
    with pytest.raises(ValueError):
        rollup.flag_any_term(F.col("c"), ["x"], "fuzzy")


@pytest.mark.parametrize(
    "first, last, journal, default, compat",
    [("A", "B", "C", "A", "A"), (None, "B", "C", "B", "C"), (None, None, "C", "C", "C"),
     ("Scotland", None, None, "Scotland", "Scotland"), (None, None, None, None, None)],
)
def test_fill_country(spark, first, last, journal, default, compat):
    frame = spark.createDataFrame(
        [(first, last, journal)],
        "affil_first_country string, affil_last_country string, journal_country string",
    )
    assert rollup.fill_country(frame).first().affil_fill_country == default
    skipped = rollup.fill_country(frame, ("first", "journal"))
    assert skipped.first().affil_fill_country == compat
    named = rollup.normalise_country(rollup.fill_country(frame)).first()
    assert named.affil_fill_country == default
    assert named.affil_first_country == ("United Kingdom" if first == "Scotland" else first)


def test_normalised_fill(spark):
    frame = spark.createDataFrame(
        [("Wales", None, None)],
        "affil_first_country string, affil_last_country string, journal_country string",
    )
    assert rollup.fill_country(frame, normalise_fill=True).first().affil_fill_country == "United Kingdom"


def test_year(spark):
    frame = spark.createDataFrame([(date(2024, 5, 1),), (None,)], "pubmed_date date")
    assert {r.year for r in rollup.add_year(frame).collect()} == {2024, None}


def full_articles(frame):
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in (part.split(" ") for part in schemas.ARTICLE.split(", "))
        if name not in frame.columns
    }
    return frame.withColumns(missing).select(*[p.split(" ")[0] for p in schemas.ARTICLE.split(", ")])


def test_landing_days_are_pruned_and_every_article_arrives(spark, tmp_path):
    rows = [(1, date(2023, 12, 31)), (2, None), (3, date(1999, 1, 1)), (None, date(2024, 1, 1))]
    frame = full_articles(spark.createDataFrame(rows, "pmid long, pubmed_date date"))
    path = str(tmp_path / "landed")
    articles.land(frame.where("pmid = 1"), path, date(2024, 1, 1), "a")
    for _ in range(2):  # a repeated batch replaces itself
        articles.land(frame.where("pmid is null or pmid > 1"), path, date(2024, 1, 2), "b")
    window = articles.read_landed(spark, path, date(2024, 1, 2), date(2024, 1, 2))
    assert {r.pmid for r in window.collect()} == {2, 3}
    shown = window._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(state" in shown and "landed_on" in shown
    assert articles.read_landed(spark, path).count() == 3
    assert [r.problems for r in articles.read_rejected(spark, path).collect()] == [["pmid"]]


def test_rows_that_were_dealt_out_already_are_landed_where_they_are(spark, tmp_path):
    rows = [(i if i % 10 else None, date(2024, 1, 1)) for i in range(60)]
    frame = full_articles(spark.createDataFrame(rows, "pmid long, pubmed_date date")).repartition(6, "pmid")
    sets = []
    for dealt in (False, True):
        path = str(tmp_path / f"landed{dealt}")
        articles.land(frame, path, date(2024, 1, 2), "a", dealt=dealt)
        found = articles.read_landed(spark, path)
        sets.append((sorted(r.pmid for r in found.collect()), articles.read_rejected(spark, path).count()))
        assert sum("state=sound" in name for name in found.inputFiles()) == (6 if dealt else 1)
    assert sets[0] == sets[1] and sets[0][1] == 6
