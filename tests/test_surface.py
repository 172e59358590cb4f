import pytest
from pyspark.sql import functions as F

from paperloom import constants
from paperloom.functions.surface import register_functions
from paperloom.functions.terms import contains_any, mentions

NAMES = {"U.S.A.": "United States", "Côte d'Ivoire": "Cote d'Ivoire", "Peru": "Peru", "Papua New Guinea": "Papua New Guinea"}
TEXTS = ["in U.S.A. and Côte d'Ivoire", "Peru Peruvian Peru", "", None, "nowhere", "Papua New Guinea, Peru", "St. Vincent", "stx vincent", "GUINEA-BISSAU"]


@pytest.fixture
def texts(spark):
    spark.createDataFrame([(t,) for t in TEXTS], "text string").createOrReplaceTempView("surface_texts")
    return spark.table("surface_texts")


def test_sql_gives_what_the_columns_give(spark, texts):
    register_functions(spark, NAMES)
    got = spark.sql("SELECT text, country_mentions(text) AS c, lmic_flag(text) AS a, lmic_lower_flag(text) AS b FROM surface_texts")
    low = F.coalesce(contains_any(F.lower("text"), constants.LOW_MIDDLE_INCOME_TERMS), F.lit(False)).cast("double")
    lower = F.coalesce(contains_any(F.lower("text"), constants.LOWER_INCOME_TERMS), F.lit(False)).cast("double")
    want = texts.select("text", mentions(F.col("text"), NAMES).alias("c"), low.alias("a"), lower.alias("b"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_table_function(spark, texts):
    register_functions(spark, NAMES)
    rows = spark.sql("SELECT text, position, country FROM surface_texts, LATERAL affiliation_countries(text)").collect()
    assert sorted((r.position, r.country) for r in rows if r.text == TEXTS[0]) == [(1, "United States"), (2, "Cote d'Ivoire")]
    assert len(rows) == 5


def test_without_names(spark, texts):
    register_functions(spark, {}, ["a.b"], [])
    assert spark.sql("SELECT count(*) AS n FROM surface_texts, LATERAL affiliation_countries(text)").first().n == 0
    assert spark.sql("SELECT lmic_flag('xAxBx') AS a, lmic_flag('ab') AS b, china_flag('China') AS c").first() == (1.0, 0.0, 1.0)
