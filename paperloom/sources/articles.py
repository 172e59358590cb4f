"""Article sources: nested records, search predicates, date window and the mark."""

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom import constants, schemas
from paperloom.functions import record
from paperloom.functions.terms import minimal_terms
from paperloom.functions.text import slashed_date
from paperloom.operators.merge import STAGED
from paperloom.streaming.ledger import sink_token

ARRIVED, STATE, BATCH = "landed_on", "state", "batch"
SOUND, REJECTED = "sound", "rejected"
CORRUPT = "_corrupt_record"
XML_OPTIONS = {
    "rowTag": schemas.RECORD_TAG,
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}
END_TAG = f"</{schemas.RECORD_TAG}>"
START_TAG = f"<{schemas.RECORD_TAG}(?=[\\s>])"


def record_texts(chunks: DataFrame, column: str = "value") -> DataFrame:
    """One row ``xml`` per record from texts that were cut behind each end tag.

    What stands before a start tag, such as the header, is left out, and so is a rest without
    one. A record that is cut off before the next one begins is a row of its own, without its
    end, and will not parse; neither will the cut-off last record of a file.
    """
    pieces = F.filter(
        F.split(column, f"(?={START_TAG})", -1), lambda piece: piece.rlike(f"^{START_TAG}")
    )
    last = F.size("pieces") - 1
    ended = F.transform(
        "pieces",
        lambda piece, i: F.when(i == last, F.concat(piece, F.lit(END_TAG))).otherwise(piece),
    )
    return chunks.select(pieces.alias("pieces")).select(F.explode(ended).alias("xml"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Nested records below ``path``; other record kinds in the files are ignored.

    Files are cut at the records' end tags, so a large one is read by many tasks, and every
    record is parsed on its own: a broken one is kept in ``_corrupt_record``.
    """
    chunks = spark.read.option("lineSep", END_TAG).text(path)
    return records_from_text(record_texts(chunks), "xml")


def stream_records(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """The same as a stream that reads every file once."""
    chunks = spark.readStream.option("lineSep", END_TAG).option("maxFilesPerTrigger", max_files)
    return records_from_text(record_texts(chunks.text(path)), "xml")


def records_from_text(df: DataFrame, xml: str) -> DataFrame:
    """Nested records held as XML text in a column, with ``_corrupt_record`` for a broken one.

    ``inline`` keeps later filters above the parser. Pushed below it they would parse the
    text again for every column they test.
    """
    ddl = f"{' '.join(schemas.RECORD.split())}, {CORRUPT} string"
    parsed = F.from_xml(F.col(xml), F.lit(ddl), XML_OPTIONS)
    return df.select(F.inline(F.array(parsed)))


def flatten_records(
    records: DataFrame,
    doi_rule: str = "last_doi",
    join_sections: bool = False,
    drop_bad: bool = False,
    pmid_only: bool = False,
    with_problems: bool = False,
) -> DataFrame:
    """One article row per nested record, as a single projection."""
    columns = {
        "pmid": record.pmid(),
        "doi": record.doi(doi_rule),
        "title": record.title(),
        "abstract": record.abstract(join_sections),
        "article_date": record.article_date(),
        "pubmed_date": record.pubmed_date(),
        "article_type": record.article_type(),
        "lang": record.lang(),
        "journal": record.journal(),
        "journal_short": record.journal_short(),
        "journal_country": record.journal_country(),
        "authors": record.authors(drop_bad),
        "author_affils": record.author_affils(drop_bad),
        "keywords": record.keywords(),
        "mesh_terms": record.mesh_terms(),
        "references_pmids": record.references_pmids(pmid_only),
    }
    if with_problems:
        broken = F.col(CORRUPT) if CORRUPT in records.columns else F.lit(None)
        unreadable = F.array(F.lit("record"))
        columns["problems"] = F.when(broken.isNotNull(), unreadable).otherwise(record.problems())
        columns[CORRUPT] = broken.cast("string")
    return records.select(*[column.alias(name) for name, column in columns.items()])


def read_articles(spark: SparkSession, path: str, **rules) -> DataFrame:
    return flatten_records(read_records(spark, path), **rules)


def _split_state(articles: DataFrame, arrived: date | Column) -> DataFrame:
    """Articles with their landing day and whether they are sound or to be rejected."""
    if "problems" not in articles.columns:
        problem = F.when(F.col("pmid").isNull(), F.lit("pmid"))
        articles = articles.withColumn("problems", F.array_compact(F.array(problem)))
    if CORRUPT not in articles.columns:
        articles = articles.withColumn(CORRUPT, F.lit(None).cast("string"))
    state = F.when(F.size("problems") > 0, F.lit(REJECTED)).otherwise(F.lit(SOUND))
    return articles.withColumns({STATE: state, ARRIVED: F.lit(arrived)})


def land(articles: DataFrame, path: str, arrived: date | Column, batch: str, dealt: bool = False) -> None:
    """Write articles to the landing table as the partition ``batch``, replacing that batch.

    Records are parsed once, here, and filed by the day they arrive, so an article without a
    date or with an old one is found by the next run like any other. Articles with problems
    (an unreadable record, id or date) are kept beside the sound ones, see ``read_rejected``.
    The rows are dealt out by their id, so that a day is read by many tasks: the rebalance hint
    splits what is too large and joins what is small, down to one file per core. Rows that come from
    a shuffle by the id are ``dealt`` already: whole articles are then not moved a second time.
    """
    rows = _split_state(articles, arrived)
    rows = rows if dealt else rows.hint("rebalance", F.col("pmid"))
    writer = rows.write.mode("overwrite").option("compression", STAGED).partitionBy(ARRIVED, STATE)
    writer.parquet(f"{path.rstrip('/')}/{BATCH}={batch}")


def land_files(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    arrived: date,
    max_files: int = 1000,
    **rules,
) -> None:
    """Land the XML files below ``source`` that no earlier run has landed, then stop.

    The stream's checkpoint remembers the files. A batch that is repeated after a failure
    replaces its own partition.
    """
    token = sink_token(spark, checkpoint)
    parsed = flatten_records(stream_records(spark, source, max_files), with_problems=True, **rules)

    def write(batch: DataFrame, number: int) -> None:
        land(batch, path, arrived, f"{token}-{number}")

    query = (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _landed(spark: SparkSession, path: str, state: str) -> DataFrame:
    keys = f"{BATCH} string, {ARRIVED} date, {STATE} string"
    schema = f"{schemas.ARTICLE}, problems array<string>, {CORRUPT} string, {keys}"
    return spark.read.schema(schema).parquet(path).where(F.col(STATE) == state)


def read_landed(
    spark: SparkSession, path: str, lo: date | None = None, hi: date | None = None
) -> DataFrame:
    """Sound articles that arrived from ``lo`` to ``hi``; other days are not listed for reading.

    ``landed_on`` stays, as the run's mark is taken from it.
    """
    rows = date_window(_landed(spark, path, SOUND), ARRIVED, lo, hi)
    return rows.drop("problems", CORRUPT, BATCH, STATE)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Articles that were put aside on landing, with their problems and a broken record's text."""
    return _landed(spark, path, REJECTED).drop(BATCH, STATE)


def search_predicate(
    title: Column,
    abstract: Column,
    headings: Column | None = None,
    phrases: Iterable[str] = constants.SEARCH_PHRASES,
    all_words: Iterable[Sequence[str]] = constants.SEARCH_ALL_WORDS,
    heading_terms: Iterable[str] = constants.SEARCH_HEADINGS,
) -> Column:
    """Any phrase, any full set of words, or any subject heading; case is ignored.

    Empty lists match nothing. Plain substrings are looked for, so no pattern runs over the text.
    """
    text = F.lower(F.concat_ws(" ", title, abstract))
    wanted = [text.contains(phrase) for phrase in minimal_terms(p.lower() for p in phrases if p)]
    for words in all_words:
        found = [text.contains(word.lower()) for word in words if word]
        if found:
            wanted.append(reduce(Column.__and__, found))
    terms = [term.lower() for term in heading_terms]
    if headings is not None and terms:
        hit = F.exists(headings, lambda h: F.lower(h).isin(terms))
        wanted.append(F.coalesce(hit, F.lit(False)))
    return reduce(Column.__or__, wanted, F.lit(False))


def match_search(df: DataFrame, **query) -> DataFrame:
    headings = F.col("mesh_terms") if "mesh_terms" in df.columns else None
    return df.where(search_predicate(F.col("title"), F.col("abstract"), headings, **query))


def date_window(df: DataFrame, column: str, lo: date | None, hi: date | None) -> DataFrame:
    """Rows whose day lies in ``lo``..``hi``, both ends included.

    The bounds are literals of the column's own type, so Parquet gets them as filters.
    """
    kind = df.schema[column].dataType
    if lo is not None:
        df = df.where(F.col(column) >= F.lit(lo).cast(kind))
    if hi is not None:
        if isinstance(kind, T.DateType):
            df = df.where(F.col(column) <= F.lit(hi))
        else:
            df = df.where(F.col(column) < F.lit(hi + timedelta(days=1)).cast(kind))
    return df


def cap(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in the given order, with the full count of hits beside."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).limit(limit).withColumn("hit_count", total)


def high_water_mark(table: DataFrame, column: str, epoch: date = date(1900, 1, 1)) -> DataFrame:
    """Latest day of the table as ``yyyy/MM/dd``; ``epoch`` when the table is empty."""
    latest = F.coalesce(F.max(F.col(column)).cast("date"), F.lit(epoch))
    return table.agg(slashed_date(latest).alias("mark"))


def mark_date(table: DataFrame, column: str, epoch: date = date(1900, 1, 1)) -> date:
    """The mark as a date for planning the next run; one row reaches the driver."""
    return table.agg(F.coalesce(F.max(F.col(column)).cast("date"), F.lit(epoch))).first()[0]


def footer_statistics(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(latest, row_count) of a Parquet table from its files' statistics; no row is read.

    ``max`` and ``count`` are pushed into the scan, which needs the second version of Parquet's
    reader: a session of its own has it, the caller's settings stay. The column is a date or a
    number; other types have no statistics that Spark would use. It fails on a file in which the
    column is NULL throughout.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.max(column).alias("latest"), F.count("*").alias("row_count"))


def mark_from_footers(spark: SparkSession, path: str, column: str, epoch: date = date(1900, 1, 1)) -> tuple[date, int]:
    """The mark and the number of rows of a Parquet table, from footers where these tell them.

    Where a file has no statistics the column is read once instead.
    """
    try:
        latest, rows = footer_statistics(spark, path, column).first()
    except Py4JJavaError as error:
        if "No min/max found" not in str(error):
            raise
        latest, rows = spark.read.parquet(path).agg(F.max(column), F.count("*")).first()
    return latest or epoch, rows or 0
