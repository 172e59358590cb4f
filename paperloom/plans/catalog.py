"""One runnable query per operator, over the whole test tables."""

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from paperloom import constants, schemas
from paperloom.functions.surface import register_functions
from paperloom.functions.text import as_flag, feature_text, render_list, slashed_date
from paperloom.operators import filters, headings, memo, merge, nametrie, positions, quality, rollup, runs, scoring, spelling
from paperloom.operators.places import Gazetteers, countries_of_texts
from paperloom.plans import stages, tables
from paperloom.plans.tables import table, to_xml
from paperloom.session import spread, work_folder
from paperloom.sources import articles
from paperloom.sources.gazetteers import country_spellings
from paperloom.streaming import handoff, incremental, stateful

WINDOW = (date(1996, 1, 1), date(1997, 12, 31))
LOADED_UNTIL = date(1997, 12, 31)
TODAY = date(2001, 12, 31)


def _day(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _scoring_text(spark: SparkSession, folder: str, costly: bool = True) -> DataFrame:
    rows = tables.prose(spark, folder, costly)
    return rows.select(
        "pmid", "abstract", feature_text(F.col("title"), F.col("abstract")).alias("feature")
    )


def feature_text_query(spark: SparkSession, folder: str) -> DataFrame:
    return _scoring_text(spark, folder, costly=False).select("pmid", "feature")


def search_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.prose(spark, folder, costly=True).withColumn("mesh_terms", F.array("source"))
    hits = articles.match_search(
        rows,
        phrases=[*constants.SEARCH_PHRASES, *[p.upper() for p in tables.PHRASES]],
        all_words=[*constants.SEARCH_ALL_WORDS, ["Keit", "UND"]],
        heading_terms=["SRC3"],
    )
    return hits.select("pmid", "title")


def search_exploded(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a supplier below two regions or one nation: a search for a heading finds all narrower ones."""
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    placed = nations.join(regions, "r_regionkey")
    upper = placed.select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    sites = tables.suppliers(spark, folder).join(nations, "n_nationkey")
    lower = sites.select(F.col("s_name").alias("child"), F.col("n_name").alias("parent"))
    closure = headings.heading_closure(upper.union(lower))
    narrower = headings.narrower_headings(closure, tables.WANTED_HEADINGS)
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("pmid"), "l_suppkey")
    named = lines.join(tables.suppliers(spark, folder).select("l_suppkey", "s_name"), "l_suppkey")
    terms = named.groupBy("pmid").agg(F.collect_set("s_name").alias("mesh_terms"))
    found = headings.search_headings(terms, "pmid", "mesh_terms", narrower)
    return found.select("pmid", F.size("mesh_terms").cast("bigint").alias("headings"))


def capped_search(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    hits = articles.date_window(orders, "o_orderdate", *WINDOW)
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return articles.cap(hits, order, constants.MAX_HITS).select("o_orderkey", "hit_count")


def date_window(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return articles.date_window(orders, "o_orderdate", *WINDOW).select(
        "o_orderkey", _day("o_orderdate").alias("day")
    )


def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    return articles.high_water_mark(table(spark, folder, "orders"), "o_orderdate")


def mark_from_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The mark of the articles' table without reading a row of it."""
    main = work_folder(spark, "dated")
    orders = table(spark, folder, "orders")
    orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("pubmed_date")).write.parquet(main)
    mark, rows = articles.mark_from_footers(spark, main, "pubmed_date")
    return spark.createDataFrame([(mark.strftime("%Y/%m/%d"), rows)], "mark string, row_count long")


def batch_stats(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    documents = table(spark, folder, "documents").select("doc_id")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    known = documents.withColumn("known", F.lit(1))
    rows = orders.join(known, "doc_id", "left").join(labels, "doc_id", "left")
    metrics = quality.batch_stats("o_orderdate", ("quality", "toxic", "known"))
    stats = rows.agg(*[column.alias(name) for name, column in metrics.items()])
    return stats.withColumn("latest_date", slashed_date(F.col("latest_date")))


def _reparsed(records: DataFrame, **rules) -> DataFrame:
    return articles.flatten_records(articles.records_from_text(records, "xml"), **rules)


def _prose_records(spark: SparkSession, folder: str) -> DataFrame:
    lang, source = F.col("lang"), F.col("source")
    record = tables.nested(
        {
            "PMID": tables.boxed("_VALUE", F.col("pmid").cast("string")),
            "MedlineJournalInfo": tables.boxed("Country", F.upper(lang)),
        },
        {
            "ArticleTitle": F.col("title"),
            "Abstract": F.when(
                F.col("abstract").isNotNull(),
                tables.boxed("AbstractText", F.array(F.col("abstract"), lang)),
            ),
            "PublicationTypeList": tables.boxed(
                "PublicationType", F.array(F.lit("Journal Article"), F.lit("Review"))
            ),
            "Language": F.array(lang, F.lit("xx")),
            "Journal": F.struct(
                source.alias("Title"), F.upper(source).alias("ISOAbbreviation")
            ),
        },
        {},
    )
    return tables.prose(spark, folder, costly=True).select(record.alias("record"))


SCALARS = [
    "pmid", "title", "abstract", "article_type", "lang", "journal", "journal_short",
    "journal_country",
]


def xml_parse_scalars(spark: SparkSession, folder: str) -> DataFrame:
    records = _prose_records(spark, folder).select(to_xml(F.col("record")).alias("xml"))
    return _reparsed(records).select(*SCALARS)


def xml_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same records written to XML files, beside files of another record kind."""
    landing = work_folder(spark, "landing")
    records = _prose_records(spark, folder).select("record.*")
    writer = records.write.format("xml").option("rootTag", "PubmedArticleSet")
    writer.option("rowTag", schemas.RECORD_TAG).mode("append").save(landing)
    books = table(spark, folder, "pages").select("page_id", "url")
    writer = books.write.format("xml").option("rootTag", "PubmedArticleSet")
    writer.option("rowTag", "PubmedBookArticle").mode("append").save(landing)
    return articles.read_articles(spark, landing).select(*SCALARS)


def _line_lists(spark: SparkSession, folder: str, *values: str) -> DataFrame:
    """Orders with their line items as one ordered list, built from the given fields."""
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    lists = rollup.ordered_entries(lines, "o_orderkey", tables.AUTHOR_ORDER, values, "lines")
    orders = spread(table(spark, folder, "orders").select("o_orderkey"))
    return orders.join(lists, "o_orderkey", "left")


def _pmid_part() -> dict[str, Column]:
    return {"PMID": tables.boxed("_VALUE", F.col("o_orderkey").cast("string"))}


def xml_doi(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_lists(spark, folder, "l_returnflag")
    ids = F.transform(
        "lines",
        lambda x: F.struct(
            F.concat(F.lit("10."), x.getField("l_suppkey"), F.lit("/"), x.getField("l_partkey"))
            .alias("_VALUE"),
            F.when(x.getField("l_returnflag") == "R", F.lit("doi")).otherwise(F.lit("pii"))
            .alias("_EIdType"),
        ),
    )
    record = tables.nested(_pmid_part(), {"ELocationID": ids}, {})
    parsed = articles.records_from_text(rows.select(to_xml(record).alias("xml")), "xml")
    rules = {"doi": "last_doi", "doi_last_id": "last_id"}
    return parsed.select(
        articles.record.pmid().alias("pmid"),
        *[articles.record.doi(rule).alias(name) for name, rule in rules.items()],
    )


def _dated_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose dates are partly missing, partly no real day."""
    orders = spread(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate"))
    year, month, day = (F.col(c) for c in ("Year", "Month", "Day"))
    parts = orders.select("o_orderkey", "o_orderpriority", *tables.date_parts(F.col("o_orderdate")))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    low = F.col("o_orderpriority") == "5-LOW"
    written = F.struct(
        year.alias("Year"),
        month.alias("Month"),
        F.when(urgent, F.lit("31")).when(~low, day).alias("Day"),
    )
    history = F.array(
        _history("pubmed", F.lit("1990"), F.lit("1"), F.lit("1")),
        _history("received", year, month, F.lit("1")),
        _history("pubmed", year, month, F.when(urgent, F.lit("30")).otherwise(day)),
        _history("medline", year, month, F.lit("2")),
    )
    record = tables.nested(
        _pmid_part(),
        {"ArticleDate": F.array(written)},
        {"History": tables.boxed("PubMedPubDate", history)},
    )
    return parts.select(to_xml(record).alias("xml"))


def _history(status: str, year: Column, month: Column, day: Column) -> Column:
    return F.struct(
        F.lit(status).alias("_PubStatus"),
        year.alias("Year"), month.alias("Month"), day.alias("Day"),
    )


def xml_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _reparsed(_dated_records(spark, folder)).select(
        "pmid",
        _day("article_date").alias("article_date"),
        _day("pubmed_date").alias("pubmed_date"),
    )


def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records with an unusable date, counted per kind beside the sound ones; parsed once."""
    rows = _reparsed(_dated_records(spark, folder), with_problems=True)
    parsed = merge.stage(rows.select("pmid", "problems"), work_folder(spark, "checked"))
    sound, failed = quality.quarantine(parsed, "problems")
    kinds = quality.problem_counts(failed, "problems")
    fine = sound.agg(F.lit("none").alias("problem"), F.count("*").alias("failed"))
    return kinds.unionByName(fine)


def _render(column: str) -> Column:
    return render_list(F.col(column)).alias(column)


def xml_author_lists(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_lists(spark, folder, "l_returnflag", "l_linestatus", "l_discount")
    people = F.transform(
        "lines",
        lambda x: F.struct(
            F.concat(F.lit("Name"), x.getField("l_suppkey")).alias("LastName"),
            F.when(x.getField("l_discount") > 0, F.concat(F.lit("P"), x.getField("l_partkey")))
            .alias("ForeName"),
            F.when(
                (x.getField("l_returnflag") != "R") | (x.getField("l_linestatus") != "O"),
                F.array(
                    tables.boxed("Affiliation", F.concat(F.lit("Lab "), x.getField("l_suppkey"))),
                    tables.boxed("Affiliation", F.lit("Second")),
                ),
            ).alias("AffiliationInfo"),
        ),
    )
    authors = F.when(F.col("lines").isNotNull(), tables.boxed("Author", people))
    record = tables.nested(_pmid_part(), {"AuthorList": authors}, {})
    xml = rows.select(to_xml(record).alias("xml"))
    parsed = articles.records_from_text(xml, "xml")
    return parsed.select(
        articles.record.pmid().alias("pmid"),
        render_list(articles.record.authors()).alias("authors"),
        render_list(articles.record.author_affils()).alias("author_affils"),
        render_list(articles.record.author_affils(drop_bad=True)).alias("known_affils"),
    )


def xml_term_lists(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_lists(spark, folder, "l_returnflag", "l_tax")
    lines, present = F.col("lines"), F.col("lines").isNotNull()
    words = F.transform(lines, lambda x: F.concat(F.lit("word "), x.getField("l_suppkey")))
    headings = F.transform(
        lines,
        lambda x: F.struct(
            F.when(x.getField("l_tax") > 0, F.concat(F.lit("Term "), x.getField("l_partkey")))
            .alias("DescriptorName"),
            F.lit("x").alias("QualifierName"),
        ),
    )
    cited = F.transform(
        lines,
        lambda x: F.struct(
            F.lit("c").alias("Citation"),
            tables.boxed(
                "ArticleId",
                F.array(
                    F.struct(
                        x.getField("l_partkey").cast("string").alias("_VALUE"),
                        F.when(x.getField("l_returnflag") == "A", F.lit("doi"))
                        .otherwise(F.lit("pubmed")).alias("_IdType"),
                    ),
                    F.struct(
                        F.concat(F.lit("9"), x.getField("l_suppkey")).alias("_VALUE"),
                        F.lit("pubmed").alias("_IdType"),
                    ),
                ),
            ).alias("ArticleIdList"),
        ),
    )
    record = tables.nested(
        {
            **_pmid_part(),
            "KeywordList": F.when(
                present,
                F.array(
                    tables.boxed("Keyword", words),
                    tables.boxed("Keyword", F.array(F.lit("late"))),
                ),
            ),
            "MeshHeadingList": F.when(present, tables.boxed("MeshHeading", headings)),
        },
        {},
        {"ReferenceList": F.when(present, F.array(tables.boxed("Reference", cited)))},
    )
    parsed = articles.records_from_text(rows.select(to_xml(record).alias("xml")), "xml")
    return parsed.select(
        articles.record.pmid().alias("pmid"),
        render_list(articles.record.keywords()).alias("keywords"),
        render_list(articles.record.mesh_terms()).alias("mesh_terms"),
        render_list(articles.record.references_pmids()).alias("references_any"),
        render_list(articles.record.references_pmids(pmid_only=True)).alias("references_pmids"),
    )


def scoring_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return filters.with_abstract(tables.prose(spark, folder)).select("pmid", "abstract")


def animal_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which no part name starts with a listed term; those without parts stay."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    lines = lines.join(parts, "l_partkey", "left")
    terms = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_set("p_name")).alias("mesh_terms")
    )
    orders = table(spark, folder, "orders").select("o_orderkey").join(terms, "o_orderkey", "left")
    kept = filters.drop_by_term_prefix(orders, prefixes=["sma", "red w"])
    return kept.select("o_orderkey", _render("mesh_terms"))


def score_binary(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.score_binary(_scoring_text(spark, folder), "label", tables.include_model())
    return rows.select("pmid", "label")


def score_binary_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same model behind the batch interface, for the rows that have an abstract."""
    rows = scoring.score_binary(
        _scoring_text(spark, folder),
        "label",
        scoring.loaded(tables.include_model()),
        where=F.col("abstract").isNotNull(),
    )
    return rows.select("pmid", "label")


def score_multilabel(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.score_binary(_scoring_text(spark, folder), "include", tables.include_model())
    rows = scoring.score_multilabel(
        rows, tables.characteristics_model(), where=F.col("include") == 1
    )
    return rows.select("pmid", *constants.CHARACTERISTICS)


def label_writeback(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    labels = table(spark, folder, "labels")
    return scoring.write_back(documents, labels, "doc_id", ["quality", "toxic"])


def positional_writeback(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the scored rows written back by position; the ids are repeated or missing."""
    rows = tables.prose(spark, folder).select(
        F.col("pmid").alias("number"), "abstract",
        F.when(F.col("pmid") % 5 != 0, F.floor(F.col("pmid") / 3)).alias("pmid"),
        feature_text(F.col("title"), F.col("abstract")).alias("feature"),
    )
    labelled = positions.with_labels(rows)
    scored = scoring.score_binary(filters.with_abstract(labelled), "include", tables.include_model())
    back = positions.assign_by_label(labelled, scored, ["include"])
    return back.select("number", "pmid", F.col("include").cast("bigint").alias("include"))


LINE = ["l_orderkey", *tables.AUTHOR_ORDER]


def _country_query(spark: SparkSession, folder: str, text: Column, known: Gazetteers) -> DataFrame:
    lines = tables.affiliation_lines(spark, folder, text).select(*LINE, "affil")
    return countries_of_texts(lines, "affil", known).select(*LINE, _render("countries"))


def extract_countries(spark: SparkSession, folder: str) -> DataFrame:
    known = Gazetteers(tables.gazetteers(spark, folder).countries)
    return _country_query(spark, folder, tables.country_text(), known)


def city_fallback(spark: SparkSession, folder: str) -> DataFrame:
    known = tables.gazetteers(spark, folder)
    text = F.when(F.col("l_returnflag") == "A", tables.country_text()).otherwise(tables.city_text())
    return _country_query(spark, folder, text, Gazetteers(known.countries, known.cities))


def tail_fallback(spark: SparkSession, folder: str) -> DataFrame:
    known = tables.gazetteers(spark, folder)
    return _country_query(
        spark, folder, tables.tail_text(), Gazetteers(known.countries, places=known.places)
    )


def place_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """All steps on mixed affiliations: country names, cities, tails and whole texts."""
    return _country_query(spark, folder, tables.mixed_text(), tables.gazetteers(spark, folder))


def place_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Institutions and countries written with up to two wrong letters, in other case, with accents."""
    sites = tables.institutions(spark, folder).select(
        "l_suppkey", F.concat("country", F.lit(" "), F.col("s_name")).alias("name")
    )
    typed = sites.select("l_suppkey", tables.misspelt(F.col("name"), F.col("l_suppkey")).alias("typed"))
    found = spelling.nearest_names(typed, "typed", sites, "name")
    return typed.join(found, "typed", "left").select(
        "l_suppkey", "typed", "name", F.col("distance").cast("bigint").alias("distance"), F.col("ties").cast("bigint").alias("ties")
    )


def extract_names_large(spark: SparkSession, folder: str) -> DataFrame:
    """Every part, customer and supplier named in the texts of all line items, which are joined together once."""
    lines = tables.trade_lines(spark, folder)
    parts = table(spark, folder, "part").select(F.col("p_name").alias("name"))
    people = table(spark, folder, "customer").select("c_name").union(table(spark, folder, "supplier").select("s_name"))
    named = nametrie.with_names(lines, "text", parts.union(people).distinct(), "name")
    return named.select(*LINE, F.array_join("mentions", "|").alias("names"))


def resolution_memo(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over affiliations: all new, half known, and the same with some institutions moved.

    Counts the texts each run resolved, and how many countries the kept texts name in the end.
    """
    known = tables.gazetteers(spark, folder)
    sites = tables.institutions(spark, folder).select("l_suppkey", "s_name", "country")
    kept = memo.Resolutions(spark, work_folder(spark, "memo"))
    texts = sites.select(F.concat(F.lit("Unit 1, "), "s_name").alias("affil"), "l_suppkey")
    others = sites.select(F.concat(F.lit("Ward 2, "), "s_name").alias("affil"), "l_suppkey")
    moved = sites.select(
        F.col("s_name").alias("city"),
        F.concat("s_name", F.lit(", "), F.when(F.col("l_suppkey") % 7 == 0, "Peru").otherwise(F.col("country"))).alias("address"),
    )
    first = Gazetteers(known.countries, known.cities)
    second = Gazetteers(known.countries, moved)
    runs_ = [(texts, first), (texts.union(others), first), (texts, second)]
    counts = [kept.resolve(rows, "affil", names) for rows, names in runs_]
    table_ = [(f"run {i}", c["new"], c["touched"]) for i, c in enumerate(counts)]
    resolved = spark.createDataFrame(table_, "what string, new long, touched long")
    named = kept.table().select(F.explode("countries").alias("what")).groupBy("what").agg(F.count("*").alias("new"))
    return resolved.unionByName(named.withColumn("touched", F.lit(0).cast("long")))


def sql_surface(spark: SparkSession, folder: str) -> DataFrame:
    """Countries and flags of affiliations, asked for in SQL alone."""
    register_functions(spark, tables.gazetteers(spark, folder).countries)
    text = F.when(F.col("l_returnflag") == "A", tables.city_text()).otherwise(tables.country_text())
    tables.affiliation_lines(spark, folder, text).select(*LINE, "affil").createOrReplaceTempView("affiliation_lines")
    return spark.sql("""
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, position, country,
          lmic_flag(country) AS lmic, lmic_lower_flag(country) AS lmic_lower, china_flag(country) AS china
        FROM affiliation_lines, LATERAL affiliation_countries(affil)""")


def _country_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A country per author position; returned open lines have none."""
    unknown = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return tables.author_lines(spark, folder).select(
        F.col("l_orderkey").alias("pmid"),
        *tables.AUTHOR_ORDER,
        F.when(~unknown, F.col("country")).alias("country"),
    )


def country_rollup(spark: SparkSession, folder: str) -> DataFrame:
    lists = rollup.rollup_lists(_country_rows(spark, folder), "pmid", tables.AUTHOR_ORDER)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pmid"), as_flag(F.col("o_orderstatus") != "P").alias("include")
    )
    joined = rollup.rendered(orders.join(lists, "pmid", "left"))
    names = [
        "affil_countries", "affil_countries_unique", "affil_first_country", "affil_last_country",
    ]
    chosen = F.col("include") == 1
    return joined.select("pmid", *[F.when(chosen, F.col(n)).alias(n) for n in names])


def _summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the roll-up's first, last and distinct countries and a journal country."""
    summary = rollup.rollup_summary(_country_rows(spark, folder), "pmid", tables.AUTHOR_ORDER)
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("pmid"), "o_custkey")
    return tables.with_journal_country(orders, folder).join(summary, "pmid", "left")


def fill_country(spark: SparkSession, folder: str) -> DataFrame:
    rows = _summaries(spark, folder)
    compat = rollup.fill_country(rows, ("first", "journal")).withColumnRenamed(
        "affil_fill_country", "fill_without_last"
    )
    named = rollup.fill_country(compat, normalise_fill=True).withColumnRenamed(
        "affil_fill_country", "fill_normalised"
    )
    return rollup.fill_country(named).select(
        "pmid", "affil_fill_country", "fill_without_last", "fill_normalised"
    )


def normalise_country(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.institutions(spark, folder).withColumn("affil_first_country", F.col("country"))
    return rollup.normalise_country(rows).select("l_suppkey", "country", "affil_first_country")


def country_flags(spark: SparkSession, folder: str) -> DataFrame:
    exact = rollup.flag_any_term(
        F.col("affil_countries_unique"), constants.LOW_MIDDLE_INCOME_TERMS, "exact"
    )
    rows = _summaries(spark, folder).withColumn("lmic_exact_flag", exact)
    return rollup.country_flags(rollup.rendered(rows)).select(
        "pmid", "countries_lc", "lmic_author_flag", "lmic_china_flag", "lmic_exact_flag"
    )


def country_flags_lower(spark: SparkSession, folder: str) -> DataFrame:
    rows = rollup.country_flags(rollup.rendered(_summaries(spark, folder)))
    compat = rollup.flag_any_term(F.col("countries_lc"), constants.LOWER_INCOME_TERMS_COMPAT)
    return rows.select("pmid", "lmic_author_lower_flag", compat.alias("lower_flag_compat"))


def year_column(spark: SparkSession, folder: str) -> DataFrame:
    rows = rollup.add_year(table(spark, folder, "orders"), "o_orderdate")
    return rows.select("o_orderkey", F.col("year").cast("bigint").alias("year"))


def envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    schema = ", ".join(f"{name} {kind}" for name, kind in orders.dtypes)
    rows = handoff.decode_rows(handoff.encode_rows(orders), schema)
    failed = F.col(handoff.CORRUPT).isNotNull().cast("int").alias("corrupt")
    return rows.withColumn("o_orderdate", _day("o_orderdate")).select(*orders.columns, failed)


def envelope_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of an old and a new set of fields decoded together by the schemas they carry."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    finished = F.col("o_orderstatus") == "F"
    old = orders.where(finished).select("o_orderkey", "o_totalprice", "o_orderdate")
    new = orders.where(~finished).select("o_orderkey", "o_totalprice", F.struct("o_custkey", "o_orderpriority").alias("customer"), F.array("o_orderstatus").alias("marks"))
    broken = orders.where("o_orderkey % 50 = 0").select(F.concat(F.lit("?"), "o_orderkey").alias("data"))
    messages = handoff.encode_described(old).union(handoff.encode_described(new)).union(broken)
    sent = merge.stage(messages, work_folder(spark, "messages"))
    rows = handoff.decode_described(sent)
    failed = F.col(handoff.CORRUPT).alias("corrupt")
    return rows.select(
        "o_orderkey", "o_totalprice", _day("o_orderdate").alias("o_orderdate"), F.col("customer.o_custkey").alias("o_custkey"),
        F.col("customer.o_orderpriority").alias("o_orderpriority"), F.array_join("marks", ",").alias("marks"), failed,
    )


def staging_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches staged at the same place: only the second is left."""
    place = work_folder(spark, "staging")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    merge.stage(orders.where("o_orderstatus = 'F'"), place, schema)
    return merge.stage(orders.where("o_orderstatus <> 'F'"), place, schema)


def merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    """Line items merged into finished orders: repeats and NULL keys in the source stay."""
    orders = table(spark, folder, "orders")
    target = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("pmid"), F.lit(0).cast("bigint").alias("detail")
    )
    key = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    source = table(spark, folder, "lineitem").select(
        key.alias("pmid"), F.col("l_partkey").alias("detail")
    )
    return target.unionByName(merge.insert_new(source, target))


DETAIL = "pmid bigint, detail bigint"


def merge_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge into a table of batches; a batch is opened only if its key index admits a key."""
    main = f"{work_folder(spark, 'indexed')}/main"
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    rows = orders.select(F.col("o_orderkey").alias("pmid"), F.lit(0).cast("bigint").alias("detail"))
    cuts = rows.agg(F.percentile_approx("pmid", [0.25, 0.5, 0.75], 1000)).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows if low is None else rows.where(F.col("pmid") > low)
        part = part if high is None else part.where(F.col("pmid") <= high)
        merge.append_new(part, main, DETAIL)
    key = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    source = table(spark, folder, "lineitem").select(key.alias("pmid"), F.col("l_partkey").alias("detail"))
    merge.append_new(source, main, DETAIL)
    return merge.read_table(spark, main, DETAIL)


EVENT = "event_id bigint, user_id bigint, event_type string, value double"


def stream_incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops that overlap, each followed by a run over what is new."""
    place = work_folder(spark, "incremental")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    for number in range(3):
        own = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(0))
        drop = events.where(own.isin(number, (number + 1) % 3))
        drop.write.mode("append").parquet(f"{place}/landing")
        stream = spark.readStream.schema(EVENT).parquet(f"{place}/landing")
        incremental.run_incremental(
            stream, f"{place}/main", EVENT, f"{place}/checkpoint", key="event_id"
        )
    return incremental.read_main(spark, f"{place}/main", EVENT)


STORED = f"{EVENT}, arrived timestamp, stored_by int"


def stream_stateful_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops of a stream that is restarted between them; recent keys are held in its state.

    The second drop repeats keys of the first inside the horizon, the third some that the state has
    given up by then, and some of its rows bear an old time.
    """
    place = work_folder(spark, "stateful")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    own = F.coalesce(F.pmod("event_id", F.lit(4)), F.lit(0))
    drops = [((0, 1), datetime(2002, 1, 1)), ((1, 2), datetime(2002, 1, 2)), ((0, 2, 3), datetime(2002, 1, 20))]
    for number, (held, day) in enumerate(drops):
        late = F.pmod("event_id", F.lit(8)) == 3
        stamp = F.when(late, F.lit(drops[0][1])).otherwise(F.lit(day))
        drop = events.where(own.isin(*held)).withColumns({"arrived": stamp.cast("timestamp"), "stored_by": F.lit(number)})
        drop.write.mode("append").parquet(f"{place}/landing")
        stream = spark.readStream.schema(STORED).parquet(f"{place}/landing")
        stateful.run_stateful(stream, f"{place}/main", STORED, f"{place}/checkpoint", "arrived", "event_id", "2 days")
    return incremental.read_main(spark, f"{place}/main", STORED).drop("arrived")


def failure_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of five or more unusable orders in the order of their dates, beside the longest one."""
    order = ["o_orderdate", "o_orderkey"]
    orders = table(spark, folder, "orders").select(*order, "o_orderpriority")
    ids = runs.numbered(orders, order, F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    summary = runs.run_summary(ids)
    found = runs.failure_runs(ids, order, 5)
    return found.select(
        F.col("first.o_orderkey").alias("first_key"),
        F.col("last.o_orderkey").alias("last_key"),
        "length",
        F.lit(summary["longest"]).cast("long").alias("longest"),
        F.lit(summary["length"]).cast("long").alias("records"),
    )


def _labelled(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    models = stages.Models(
        tables.include_model(),
        tables.mature_model(),
        tables.characteristics_model(),
    )
    screened = merge.stage(stages.screen(rows, models.include), work_folder(spark, "handoff"))
    return stages.label(screened, models, tables.gazetteers(spark, folder))


def _parsed_articles(spark: SparkSession, folder: str) -> DataFrame:
    return _reparsed(tables.article_records(spark, folder))


def main_layout(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as articles through both stages, in the main table's 84 columns."""
    rows = merge.to_main_layout(_labelled(spark, _parsed_articles(spark, folder), folder))
    shown = {name: _day(name) for name in ("article_date", "pubmed_date")}
    lists = [name for name, kind in rows.dtypes if kind.startswith("array")]
    return rows.withColumns({**shown, **{name: _render(name) for name in lists}})


def _landed_articles(spark: SparkSession, folder: str) -> str:
    """All orders parsed and landed: those of the loaded time on one day, the others on the next."""
    landed = work_folder(spark, "landed")
    arrived = F.when(F.col("pubmed_date") <= F.lit(LOADED_UNTIL), F.lit(LOADED_UNTIL)).otherwise(F.lit(TODAY))
    articles.land(_parsed_articles(spark, folder), landed, arrived, "all", dealt=True)
    return landed


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run: parse, land, window, search, score, countries, flags, insert-only merge."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pmid"), F.col("o_orderdate").cast("date").alias("pubmed_date")
    )
    main = orders.where(F.col("pubmed_date") <= F.lit(LOADED_UNTIL))
    query = {
        "phrases": [*constants.SEARCH_PHRASES, *tables.PHRASES],
        "heading_terms": tables.HEADINGS,
    }
    window = articles.read_landed(spark, _landed_articles(spark, folder), TODAY, TODAY)
    found = stages.new_articles(window, main, search=query).drop(articles.ARRIVED)
    labelled = merge.stage(_labelled(spark, found, folder), work_folder(spark, "labelled"))
    fresh = merge.insert_new(labelled, main)
    label_count = sum(F.coalesce(F.col(name), F.lit(0.0)) for name in constants.CHARACTERISTICS)
    return fresh.select(
        "pmid", "doi", _day("pubmed_date").alias("pubmed_date"), "include", "mature",
        label_count.alias("label_count"), "affil_countries", "affil_first_country",
        "affil_last_country", "affil_fill_country", "countries_lc", "lmic_author_flag",
        "lmic_author_lower_flag", "lmic_china_flag",
    )


def _short_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as articles with few fields; urgent ones have no date, returned ones a late one."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    dated = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate").cast("date"))
    known = {
        "pmid": F.col("o_orderkey"),
        "title": F.concat(F.lit("Order "), F.col("o_orderkey")),
        "abstract": F.when(F.col("o_orderstatus") != "P", F.lit("a heit and that")),
        "pubmed_date": F.when(F.col("o_orderpriority") == "5-LOW", F.lit(date(1990, 1, 1))).otherwise(dated),
    }
    fields = [part.split(" ") for part in schemas.ARTICLE.split(", ")]
    return orders.select(*[known.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields])


FIRST_DAY, SECOND_DAY = date(2002, 1, 1), date(2002, 1, 2)


def landed_window(spark: SparkSession, folder: str) -> DataFrame:
    """Two landing days; articles without a date or with an old one come out once, on their day."""
    landed = work_folder(spark, "landed")
    rows = _short_articles(spark, folder)
    articles.land(rows.where("pmid % 2 = 0"), landed, FIRST_DAY, "first")
    articles.land(rows.where("pmid % 2 = 1"), landed, SECOND_DAY, "second")
    days = [articles.read_landed(spark, landed, day, day) for day in (FIRST_DAY, SECOND_DAY)]
    both = days[0].unionByName(days[1])
    return both.select("pmid", _day("pubmed_date").alias("pubmed_date"), _day("landed_on").alias("landed_on"))


def publish_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Daily first stages: each reports all hits and what it published, the last one with a cap."""
    place = work_folder(spark, "publish")
    landed, messages = f"{place}/landed", f"{place}/messages"
    rows = _short_articles(spark, folder)
    search = {"phrases": ["order"]}
    counts = []
    for number, (day, limit) in enumerate([(FIRST_DAY, None), (SECOND_DAY, 100)]):
        articles.land(rows.where(F.col("pmid") % 2 == number), landed, day, str(number))
        found = stages.publish_new(
            spark, landed, f"{place}/main", messages, tables.include_model(), day, search, limit
        )
        counts.append((number, found["hit_count"], found["row_count"], found["rejected_count"]))
    return spark.createDataFrame(counts, "run int, hit_count long, row_count long, rejected_count long")


def merge_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    """A batch load, a streaming run and another batch load into one table, keys overlapping."""
    place = work_folder(spark, "writers")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    third = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(0))
    main = f"{place}/main"

    def load(remainders: list[int]) -> None:
        batch = merge.stage(events.where(third.isin(remainders)), f"{place}/staging", EVENT)
        merge.append_new(batch, main, EVENT, "event_id", ["user_id"])

    load([0])
    events.where(third.isin(0, 1)).write.mode("append").parquet(f"{place}/landing")
    stream = spark.readStream.schema(EVENT).parquet(f"{place}/landing")
    incremental.run_incremental(stream, main, EVENT, f"{place}/checkpoint", key="event_id")
    load([1, 2])
    return merge.read_table(spark, main, EVENT)


def _record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Records as XML lines; every tenth is cut off, every tenth malformed, every tenth has no id."""
    documents = spread(table(spark, folder, "documents").select("doc_id", "lang"))
    third = F.pmod("doc_id", F.lit(10))
    record = tables.nested(
        {"PMID": tables.boxed("_VALUE", F.when(third == 3, F.lit("none")).otherwise(F.col("doc_id").cast("string")))},
        {"ArticleTitle": F.col("lang")},
        {},
    )
    xml = to_xml(record)
    broken = (
        F.when(third == 1, F.substring_index(xml, "</MedlineCitation>", 1))
        .when(third == 2, F.replace(xml, F.lit("</PMID>"), F.lit("</PMIT>")))
        .otherwise(xml)
    )
    return documents.select("doc_id", broken.alias("value"))


def quarantine_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged XML files through the landing stream: what stays sound and what was put aside."""
    place = work_folder(spark, "quarantine")
    _record_lines(spark, folder).select("value").write.text(f"{place}/files")
    articles.land_files(spark, f"{place}/files", f"{place}/landed", f"{place}/checkpoint", FIRST_DAY)
    sound = articles.read_landed(spark, f"{place}/landed").select(F.lit("sound").alias("problem"))
    failed = articles.read_rejected(spark, f"{place}/landed").select(F.explode("problems").alias("problem"))
    return sound.unionByName(failed).groupBy("problem").agg(F.count("*").alias("records"))


def failure_gate(spark: SparkSession, folder: str) -> DataFrame:
    """A load with few failures passes, one with many stops before the table."""
    place = work_folder(spark, "gate")
    lines = _short_articles(spark, folder).withColumn("include", F.lit(1))
    outcomes = []
    for name, share in (("few", 100), ("many", 3)):
        broken = lines.withColumn(
            "problem", F.when(F.col("pmid") % share == 0, F.lit("no id"))
        )
        watched, counts = quality.observed(broken, f"gate_{name}", quality.failure_metrics("problem"))
        staged = merge.stage(watched.select("pmid", "problem"), f"{place}/{name}")
        try:
            quality.gate(counts)
            loaded = merge.insert_new(staged.where("problem is null"), staged.limit(0)).count()
        except quality.TooManyFailures:
            loaded = 0
        outcomes.append((name, counts.get["row_count"], counts.get["failed_count"], loaded))
    return spark.createDataFrame(outcomes, "load string, staged long, failed long, loaded long")


def _main_rows(rows: DataFrame, **known: Column) -> DataFrame:
    """Rows in the main table's layout; what is not known is NULL."""
    have = {"pmid": F.col("pmid"), **known}
    kinds = {"author_affils": "array<string>", **schemas.MAIN_TYPES}
    return rows.select(*[have.get(n, F.lit(None)).cast(kinds[n]).alias(n) for n in schemas.MAIN_TYPES])


def stage_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Every stage with few and with many unusable records: what failed and what reached its sink."""
    place = work_folder(spark, "gates")
    articles_ = _short_articles(spark, folder)
    key, outcomes = F.col("pmid"), []

    def outcome(stage: str, case: str, run: Callable[[str], dict | None], sink: Callable[[str], DataFrame]) -> None:
        where = f"{place}/{stage}_{case}"
        try:
            run(where)
            stopped = 0
        except (quality.TooManyFailures, StreamingQueryException) as error:
            if "failed" not in str(error):
                raise
            stopped = 1
        outcomes.append((stage, case, stopped, sink(where).count()))

    def stored(where: str) -> DataFrame:
        return merge.read_table(spark, f"{where}/main", schemas.MAIN)

    nobody = F.array().cast("array<string>")
    for case, bad in {"few": key % 25 == 0, "many": key % 10 == 0, "in_a_row": key < 20}.items():
        labelled = _main_rows(articles_, include=F.lit(1), author_affils=F.when(bad, nobody))
        load = lambda where, rows=labelled: stages.load_main(
            rows, f"{where}/staging", f"{where}/main", record_order=["pmid"]
        )
        outcome("load", case, load, stored)

    for case, share in {"few": 25, "many": 10}.items():
        found = articles_.withColumn("pmid", F.when(key % share != 0, key))

        def publish(where: str, rows: DataFrame = found) -> None:
            articles.land(rows, f"{where}/landed", FIRST_DAY, "one")
            stages.publish_new(
                spark, f"{where}/landed", f"{where}/main", f"{where}/messages", tables.include_model(), FIRST_DAY, {"phrases": ["order"]}
            )

        def messages(where: str) -> DataFrame:
            return merge.read_table(spark, f"{where}/messages.ledger", stages.LEDGER).where("row_count > 0")

        outcome("publish", case, publish, messages)

        scored = articles_.withColumns({"feature": F.lit("x"), "include": F.lit(0)})
        sent = handoff.encode_rows(scored.where(key % share != 0))
        broken = scored.where(key % share == 0).select(F.concat(F.lit("?"), key).alias("data"))

        def label(where: str, lines: DataFrame = sent.union(broken)) -> None:
            lines.write.option("compression", "gzip").text(f"{where}/messages")
            models = stages.Models(tables.include_model(), tables.mature_model(), tables.characteristics_model())
            names = Gazetteers(tables.gazetteers(spark, folder).countries)
            stages.label_messages(spark, f"{where}/messages", f"{where}/main", f"{where}/checkpoint", models, names)

        outcome("label", case, label, stored)
    return spark.createDataFrame(outcomes, "stage string, load string, stopped int, reached long")


def ingest_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Three drops of XML files with overlapping ids, and a last run without a drop."""
    place = work_folder(spark, "ingest")
    lines = _record_lines(spark, folder).where("doc_id % 10 > 3")
    for drop in range(4):
        if drop < 3:
            own = lines.where((F.col("doc_id") % 3).isin(drop, (drop + 1) % 3))
            own.select("value").write.mode("append").text(f"{place}/files")
        day = date(2002, 1, 1 + drop)
        articles.land_files(spark, f"{place}/files", f"{place}/landed", f"{place}/checkpoint", day)
    landed = articles.read_landed(spark, f"{place}/landed")
    return landed.groupBy("pmid").agg(
        F.count("*").alias("landed"), _day(F.min("landed_on")).alias("first_day")
    )


def country_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Institutions whose country is written with a common other spelling."""
    spelled = F.array(*[F.lit(name) for name in tables.ALIASED])
    rows = tables.suppliers(spark, folder).select(
        "l_suppkey",
        F.concat(
            F.col("s_name"), F.lit(", "), F.get(spelled, F.col("n_nationkey"))
        ).alias("affil"),
    )
    found = countries_of_texts(rows, "affil", Gazetteers(country_spellings(spark)))
    return found.select("l_suppkey", _render("countries"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feature_text": feature_text_query,
    "search_filter": search_filter,
    "search_exploded": search_exploded,
    "capped_search": capped_search,
    "date_window": date_window,
    "high_water_mark": high_water_mark,
    "mark_from_statistics": mark_from_statistics,
    "batch_stats": batch_stats,
    "xml_parse_scalars": xml_parse_scalars,
    "xml_file_scan": xml_file_scan,
    "xml_doi": xml_doi,
    "xml_dates": xml_dates,
    "xml_author_lists": xml_author_lists,
    "xml_term_lists": xml_term_lists,
    "scoring_candidates": scoring_candidates,
    "animal_filter": animal_filter,
    "score_binary": score_binary,
    "score_binary_batches": score_binary_batches,
    "score_multilabel": score_multilabel,
    "label_writeback": label_writeback,
    "positional_writeback": positional_writeback,
    "extract_countries": extract_countries,
    "city_fallback": city_fallback,
    "tail_fallback": tail_fallback,
    "place_resolution": place_resolution,
    "resolution_memo": resolution_memo,
    "extract_names_large": extract_names_large,
    "sql_surface": sql_surface,
    "place_spelling": place_spelling,
    "country_rollup": country_rollup,
    "fill_country": fill_country,
    "normalise_country": normalise_country,
    "country_flags": country_flags,
    "country_flags_lower": country_flags_lower,
    "quarantine_counts": quarantine_counts,
    "year_column": year_column,
    "envelope_roundtrip": envelope_roundtrip,
    "envelope_evolution": envelope_evolution,
    "staging_overwrite": staging_overwrite,
    "merge_insert_only": merge_insert_only,
    "merge_indexed": merge_indexed,
    "stream_incremental_merge": stream_incremental_merge,
    "stream_stateful_merge": stream_stateful_merge,
    "failure_runs": failure_runs,
    "main_layout": main_layout,
    "landed_window": landed_window,
    "publish_counts": publish_counts,
    "merge_two_writers": merge_two_writers,
    "quarantine_pipeline": quarantine_pipeline,
    "failure_gate": failure_gate,
    "stage_gates": stage_gates,
    "ingest_increments": ingest_increments,
    "country_aliases": country_aliases,
    "flagship": flagship,
}
