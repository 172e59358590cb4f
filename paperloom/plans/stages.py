"""The two stages of a run: collect and screen, then label and insert."""

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants, schemas
from paperloom.functions.text import feature_text, zero_filled
from paperloom.operators import quality, rollup, runs
from paperloom.operators.filters import scoring_candidate
from paperloom.operators.merge import (
    append_new,
    insert_new,
    read_table,
    stage,
    to_main_layout,
)
from paperloom.operators.places import Gazetteers, countries_of_articles
from paperloom.operators.scoring import Model, TermLabels, TermModel, score_binary, score_multilabel
from paperloom.sources.articles import (
    ARRIVED,
    date_window,
    match_search,
    read_landed,
    read_rejected,
)
from paperloom.streaming import handoff
from paperloom.streaming.incremental import run_incremental

BinaryModel = TermModel | Callable[[], Model]


@dataclass(frozen=True)
class Models:
    include: BinaryModel
    mature: BinaryModel
    characteristics: TermLabels | Callable[[], Model]


def new_articles(
    articles: DataFrame,
    main: DataFrame,
    search: dict | None = None,
    limit: int | None = None,
    date_column: str = "pubmed_date",
) -> DataFrame:
    """Matching articles; all of them, unless the caller asks for a ``limit``.

    With a ``limit`` only articles the main table does not hold count, and the oldest come
    first, those without a date last. Articles without an id are never among them. The chosen
    rows are dealt out again, so later steps do not run in one task.
    """
    hits = match_search(articles, **(search or {}))
    if limit is None:
        return hits
    unseen = insert_new(hits.where(F.col("pmid").isNotNull()), main)
    chosen = unseen.orderBy(F.col(date_column).asc_nulls_last(), F.col("pmid")).limit(limit)
    return chosen.repartition("pmid")


def screen(
    articles: DataFrame,
    model: BinaryModel,
    animal_filter: bool = True,
    null_text: str = "nan",
) -> DataFrame:
    """First stage: scoring text and the include label; unscored articles get 0."""
    text = feature_text(F.col("title"), F.col("abstract"), null_text)
    scored = score_binary(
        articles.withColumn("feature", text),
        "include",
        model,
        where=scoring_candidate(animal_filter),
    )
    return scored.withColumn("include", zero_filled(F.col("include")))


def label(
    screened: DataFrame,
    models: Models,
    gazetteers: Gazetteers,
    fill_order: Sequence[str] = ("first", "last", "journal"),
    lower_terms: Iterable[str] = constants.LOWER_INCOME_TERMS,
) -> DataFrame:
    """Second stage: countries, flags and year, then maturity and characteristics.

    The country step reads its input more than once, so ``screened`` should be a written
    table (the hand-off). The models come last and see each article once.
    """
    chosen = F.col("include") == 1
    placed = add_country_columns(screened, gazetteers, chosen, fill_order, lower_terms)
    scored = score_binary(placed, "mature", models.mature, where=chosen)
    scored = scored.withColumn("mature", zero_filled(F.col("mature")))
    return score_multilabel(scored, models.characteristics, where=chosen)


def add_country_columns(
    df: DataFrame,
    gazetteers: Gazetteers,
    where: Column,
    fill_order: Sequence[str] = ("first", "last", "journal"),
    lower_terms: Iterable[str] = constants.LOWER_INCOME_TERMS,
) -> DataFrame:
    """All country columns and the year, with lists rendered as the sink stores them."""
    listed = rollup.list_columns(countries_of_articles(df, gazetteers, where))
    filled = rollup.fill_country(listed, fill_order)
    named = rollup.rendered(rollup.normalise_country(filled))
    return rollup.add_year(rollup.country_flags(named, lower_terms))


def article_problem() -> Column:
    """Why an article cannot be loaded: no id, or an empty affiliation list though it was chosen."""
    chosen = F.coalesce(F.col("include") == 1, F.lit(False))
    return F.when(F.col("pmid").isNull(), F.lit("no id")).when(
        chosen & (F.size("author_affils") == 0), F.lit("empty affiliation list")
    )


def load_main(
    labelled: DataFrame,
    staging: str,
    main: str,
    max_failure_ratio: float = 0.05,
    batch: str | None = None,
    record_order: Sequence[str] | None = None,
    stop_after: int = 5,
) -> dict:
    """Stage the batch, check its failures, then insert the unseen articles that have an id.

    The gate reads counts gathered while staging, so it costs no further pass. With a
    ``record_order``, columns of the main table, ``stop_after`` failing records in a row stop the
    load too; only a batch with so many failures is put in order. Returns the counts.
    """
    checked = labelled.withColumn("problem", article_problem())
    watched, counts = quality.observed(checked, "load", quality.failure_metrics("problem"))
    staged = stage(to_main_layout(watched), staging, schemas.MAIN)
    quality.gate(counts, max_failure_ratio)
    if record_order and counts.get["failed_count"] >= stop_after:
        runs.consecutive_gate(staged, record_order, article_problem().isNotNull(), stop_after)
    append_new(staged.where(F.col("pmid").isNotNull()), main, schemas.MAIN, batch=batch)
    return counts.get


LEDGER = "landed_on date, hit_count bigint, row_count bigint"


def published_until(spark: SparkSession, ledger: str) -> date | None:
    """The last landing day whose hits were all published; None before the first run."""
    done = read_table(spark, ledger, LEDGER).where("hit_count = row_count")
    return done.agg(F.max("landed_on")).first()[0]


def publish_new(
    spark: SparkSession,
    landed: str,
    main: str,
    messages: str,
    model: BinaryModel,
    today: date,
    search: dict | None = None,
    limit: int | None = None,
    max_failure_ratio: float = 0.05,
) -> dict:
    """First stage as a daily run: articles landed since the last run become messages.

    The window is on the landing day, so late articles and those without a date are taken.
    The mark is the last day all of whose hits were published; it stands in a ledger beside the
    messages. Its day is read again, since more may have landed later on it; the merge drops
    what the main table holds. Rejected articles of the window count as failures for the gate,
    which stops the run before anything is published.

    Returns the batch's counts, with ``hit_count`` for all hits and ``row_count`` for the
    published ones, gathered while the messages are written.
    """
    ledger = f"{messages.rstrip('/')}.ledger"
    since = published_until(spark, ledger)
    window = read_landed(spark, landed, since, today)
    rejected = date_window(read_rejected(spark, landed), ARRIVED, since, today).count()
    rows = window.count()
    quality.gate({"failed_count": rejected, "row_count": rows + rejected}, max_failure_ratio)
    table = read_table(spark, main, schemas.MAIN)
    if limit is not None:
        hits = insert_new(match_search(window, **(search or {})), table).count()
    found = new_articles(window, table, search=search, limit=limit).drop(ARRIVED)
    metrics = quality.batch_stats("pubmed_date", ("include",))
    watched, counts = quality.observed(screen(found, model), "publish", metrics)
    handoff.publish(watched, messages)
    counts = {"hit_count": counts.get["row_count"] if limit is None else hits, **counts.get}
    entry = (today, counts["hit_count"], counts["row_count"])
    write = spark.createDataFrame([entry], LEDGER).coalesce(1).write.mode("overwrite")
    write.parquet(f"{ledger}/batch={today:%Y%m%d}")
    return {**counts, "rejected_count": rejected}


def label_messages(
    spark: SparkSession,
    messages: str,
    main: str,
    checkpoint: str,
    models: Models,
    gazetteers: Gazetteers,
    max_failure_ratio: float = 0.05,
    **choices,
) -> None:
    """Second stage as an incremental run: new messages are labelled and inserted.

    Each batch is decoded once and staged. Messages that cannot be read or hold no id go to
    ``rejected`` beside the checkpoint, one folder per batch. A batch with too many of them
    stops the run before the sink and is taken up again by the next one.
    """
    arrived = handoff.read_messages(spark, messages, schemas.ARTICLE_SCORED)
    unreadable = F.col(handoff.CORRUPT).isNotNull()

    def decoded(batch: DataFrame, number: int) -> DataFrame:
        failed = F.when(unreadable | F.col("pmid").isNull(), F.lit("message"))
        checked = batch.withColumn("problem", failed)
        watched, counts = quality.observed(checked, f"decode{number}", quality.failure_metrics("problem"))
        staged = stage(watched, f"{checkpoint}/decoded")
        bad = staged.where(F.col("problem").isNotNull())
        bad.drop("problem").write.mode("overwrite").parquet(f"{checkpoint}/rejected/batch={number}")
        quality.gate(counts, max_failure_ratio)
        return staged.where(F.col("problem").isNull()).drop("problem", handoff.CORRUPT)

    def labelled(batch: DataFrame) -> DataFrame:
        return to_main_layout(label(batch, models, gazetteers, **choices))

    run_incremental(
        arrived, main, schemas.MAIN, f"{checkpoint}/sound", transform=labelled,
        dedupe_by=["pubmed_date"], prepare=decoded,
    )
