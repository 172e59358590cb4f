"""Both stages end to end on a few records."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.constants import CHARACTERISTICS, LOWER_INCOME_TERMS_COMPAT
from paperloom.operators import quality, scoring
from paperloom.operators.merge import read_table
from paperloom.operators.places import Gazetteers
from paperloom.plans import stages
from paperloom.sources.articles import land

COLUMNS = (
    "pmid bigint, title string, abstract string, pubmed_date date, journal_country string, "
    "author_affils array<string>, mesh_terms array<string>"
)
ROWS = [
    (1, "Deep learning", "good one", date(2024, 1, 1), "England", ["x, Nigeria", "y, Peru"], None),
    (2, "Deep learning", "good", date(2024, 1, 2), "Wales", ["nowhere", "z, Scotland"], ["Humans"]),
    (3, "Deep learning", None, date(2024, 1, 3), "England", ["x, Peru"], None),
    (4, "Deep learning", "good", date(2024, 1, 3), "England", ["x, Peru"], ["Mice"]),
    (5, "Deep learning", "bad", date(2024, 1, 3), "England", ["x, Peru"], None),
    (6, "Other", "good", date(2024, 1, 3), "England", ["x, Peru"], None),
    (7, "Deep learning", "good", date(2023, 1, 1), "England", ["x, Peru"], None),
]
NAMES = {n: n for n in ["Nigeria", "Peru", "Scotland"]}
MODELS = stages.Models(
    scoring.TermModel({"good": 1.0}),
    scoring.loaded(scoring.TermModel({"one": 1.0})),
    scoring.loaded(
        scoring.TermLabels(["good"], [[1.0]] + [[-1.0]] * 55, [0.0] * 56)
    ),
)


@pytest.fixture
def articles(spark):
    frame = spark.createDataFrame(ROWS, COLUMNS)
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in (part.split(" ") for part in schemas.ARTICLE.split(", "))
        if name not in frame.columns
    }
    return frame.withColumns(missing)


def test_new_articles_take_every_hit_unless_capped(spark, articles):
    main = spark.createDataFrame([(1, date(2024, 1, 1))], "pmid long, pubmed_date date")
    found = stages.new_articles(articles, main)
    assert {r.pmid for r in found.collect()} == {1, 2, 3, 4, 5, 7}
    capped = stages.new_articles(articles, main, limit=2)
    assert {r.pmid for r in capped.collect()} == {7, 2}


def test_capped_runs_reach_every_article(spark, articles):
    """Rows without an id or date do not block the others."""
    nameless = articles.where("pmid = 5").withColumn("pmid", F.lit(None).cast("long"))
    undated = articles.where("pmid = 3").withColumns({"pmid": F.lit(8).cast("long"), "pubmed_date": F.lit(None).cast("date")})
    rows = articles.unionByName(nameless).unionByName(nameless).unionByName(undated)
    main = spark.createDataFrame([], "pmid long, pubmed_date date")
    for size in (2, 4, 6, 7, 7):
        found = stages.new_articles(rows, main, limit=2)
        main = spark.createDataFrame(
            main.union(found.select("pmid", "pubmed_date")).collect(), main.schema
        )
        assert main.count() == size
    assert {r.pmid for r in main.collect()} == {1, 2, 3, 4, 5, 7, 8}


def test_screen(articles):
    rows = {r.pmid: r for r in stages.screen(articles, MODELS.include).collect()}
    assert {k for k, r in rows.items() if r.include == 1} == {1, 2, 6, 7}
    assert rows[3].feature == "Deep learning nan" and rows[3].include == 0
    compat = stages.screen(articles, MODELS.include, animal_filter=False)
    assert {r.pmid for r in compat.where("include = 1").collect()} == {1, 2, 4, 6, 7}


def test_label(articles):
    labelled = stages.label(stages.screen(articles, MODELS.include), MODELS, Gazetteers(NAMES))
    rows = {r.pmid: r for r in labelled.collect()}
    assert {k: r.mature for k, r in rows.items()} == {k: int(k == 1) for k in rows}
    assert rows[1].affil_countries == "['Nigeria', 'Peru']"
    assert rows[1].lmic_author_lower_flag == 1.0 and rows[1].year == 2024
    assert rows[2].affil_countries == "[nan, 'Scotland']"
    assert (rows[2].affil_first_country, rows[2].affil_last_country) == (None, "Scotland")
    assert rows[2].affil_fill_country == "Scotland"
    assert rows[5].affil_countries is None and rows[5].affil_fill_country == "England"
    assert rows[5].countries_lc == "nan"
    assert [rows[1][c] for c in CHARACTERISTICS] == [1.0] + [0.0] * 55
    assert all(rows[5][c] is None for c in CHARACTERISTICS)


def test_compat_choices(articles):
    screened = stages.screen(articles, MODELS.include)
    labelled = stages.label(
        screened, MODELS, Gazetteers(NAMES), ("first", "journal"), LOWER_INCOME_TERMS_COMPAT
    )
    rows = {r.pmid: r for r in labelled.collect()}
    assert rows[2].affil_fill_country == "Wales"
    assert rows[1].lmic_author_lower_flag == 0.0


def test_load_main_twice_inserts_once(spark, articles, tmp_path):
    labelled = stages.label(stages.screen(articles, MODELS.include), MODELS, Gazetteers(NAMES))
    for _ in range(2):
        stages.load_main(labelled, f"{tmp_path}/staging", f"{tmp_path}/main")
    main = read_table(spark, f"{tmp_path}/main", schemas.MAIN)
    assert main.count() == len(ROWS)
    assert main.dtypes == list(schemas.MAIN_TYPES.items())


def test_load_main_stops_before_the_table_on_too_many_failures(spark, articles, tmp_path):
    broken = articles.withColumn("author_affils", F.array().cast("array<string>"))
    labelled = stages.label(stages.screen(broken, MODELS.include), MODELS, Gazetteers(NAMES))
    with pytest.raises(quality.TooManyFailures):
        stages.load_main(labelled, f"{tmp_path}/staging", f"{tmp_path}/main")
    assert read_table(spark, f"{tmp_path}/main", schemas.MAIN).count() == 0


@pytest.fixture
def daily(spark, articles, tmp_path):
    columns = [part.split(" ")[0] for part in schemas.ARTICLE.split(", ")]
    landed, main, messages = (f"{tmp_path}/{n}" for n in ("landed", "main", "messages"))

    def arrive(day, where, ready=articles.select(*columns)):
        land(ready.where(where), landed, day, f"{day}-{abs(hash(where))}")

    def run(day, gate=0.05, **options):
        counts = stages.publish_new(
            spark, landed, main, messages, MODELS.include, day, max_failure_ratio=gate, **options
        )
        stages.label_messages(
            spark, messages, main, f"{tmp_path}/checkpoint", MODELS, Gazetteers(NAMES), max_failure_ratio=gate
        )
        table = read_table(spark, main, schemas.MAIN)
        return counts, sorted((r.pmid, r.affil_first_country) for r in table.collect())

    return arrive, run, tmp_path


def test_daily_runs_from_landing_to_main(spark, daily):
    arrive, run, place = daily
    arrive(date(2024, 1, 2), "pmid in (1, 2)")
    counts, table = run(date(2024, 1, 2))
    assert counts == {"row_count": 2, "hit_count": 2, "latest_date": date(2024, 1, 2), "include_count": 2, "rejected_count": 0}
    assert table == [(1, "Nigeria"), (2, None)]
    # Late: its own date lies before everything that is loaded.
    arrive(date(2024, 1, 3), "pmid not in (1, 2)")
    spark.createDataFrame([("not a message",)], "value string").write.mode("append").text(f"{place}/messages")
    counts, table = run(date(2024, 1, 3), gate=0.5)
    assert [pmid for pmid, _ in table] == [1, 2, 3, 4, 5, 7]
    assert spark.read.parquet(f"{place}/checkpoint/rejected").count() == 1
    assert run(date(2024, 1, 4))[1] == table


def test_a_capped_daily_run_goes_on_where_it_stopped(daily):
    arrive, run, _ = daily
    arrive(date(2024, 1, 2), "pmid > 0")
    sizes = []
    for day in (2, 3, 4, 5):
        counts, table = run(date(2024, 1, day), limit=2)
        sizes.append((counts["hit_count"], counts["row_count"], len(table)))
    assert sizes == [(6, 2, 2), (4, 2, 4), (2, 2, 6), (0, 0, 6)]


def test_articles_without_an_id_stop_the_daily_run_and_are_never_inserted(spark, articles, daily):
    arrive, run, place = daily
    columns = [part.split(" ")[0] for part in schemas.ARTICLE.split(", ")]
    nameless = articles.select(*columns).withColumn("pmid", F.when(F.col("pmid") > 1, F.col("pmid")))
    arrive(date(2024, 1, 2), "true", nameless)
    with pytest.raises(quality.TooManyFailures):
        run(date(2024, 1, 2))
    for _ in range(2):
        counts, table = run(date(2024, 1, 2), gate=0.5)
        assert counts["rejected_count"] == 1
        assert [pmid for pmid, _ in table] == [2, 3, 4, 5, 7]


def test_too_many_unreadable_messages_stop_the_second_stage(spark, daily):
    arrive, run, place = daily
    arrive(date(2024, 1, 2), "pmid in (1, 2)")
    spark.createDataFrame([("x",)] * 3, "value string").write.mode("append").text(f"{place}/messages")
    with pytest.raises(Exception, match="3 of 5 rows failed"):
        run(date(2024, 1, 2))
    assert read_table(spark, f"{place}/main", schemas.MAIN).count() == 0
    assert spark.read.parquet(f"{place}/checkpoint/rejected").count() == 3


def test_loading_an_article_without_an_id_fails_and_is_left_out(spark, articles, tmp_path):
    rows = articles.withColumn("pmid", F.when(F.col("pmid") > 1, F.col("pmid")))
    labelled = stages.label(stages.screen(rows, MODELS.include), MODELS, Gazetteers(NAMES))
    with pytest.raises(quality.TooManyFailures):
        stages.load_main(labelled, f"{tmp_path}/staging", f"{tmp_path}/main")
    counts = stages.load_main(labelled, f"{tmp_path}/staging", f"{tmp_path}/main", 0.5)
    assert counts == {"row_count": 7, "failed_count": 1}
    assert read_table(spark, f"{tmp_path}/main", schemas.MAIN).where("pmid is null").count() == 0
