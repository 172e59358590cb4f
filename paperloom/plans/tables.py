"""The test tables read as articles.

An order is an article, its line items are the author positions, suppliers are
institutions, nations are countries and documents supply titles and abstracts.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.constants import CHARACTERISTICS
from paperloom.operators.lookup import BROADCAST_BYTES, measured_bytes
from paperloom.operators.places import Gazetteers
from paperloom.operators.rollup import ordered_entries
from paperloom.operators.scoring import TermLabels, TermModel
from paperloom.session import spread
from paperloom.sources.gazetteers import name_table

# The countries the numbered nations stand for.
COUNTRIES = [
    "Algeria", "Argentina", "Brazil", "Canada", "Egypt", "Ethiopia", "France", "Germany",
    "India", "Indonesia", "Iran", "Iraq", "Japan", "England", "Kenya", "Scotland",
    "Mozambique", "Peru", "China", "Dominican Republic", "Saudi Arabia", "Nigeria",
    "Russia", "United Kingdom", "United States",
]

# Other spellings, one for each numbered nation.
ALIASED = [
    "USA", "UK", "England", "Scotland", "Wales", "Czech Republic", "Viet Nam", "Hong Kong",
    "Ivory Coast", "Russian Federation", "P.R. China", "Côte d'Ivoire", "Cabo Verde",
    "Kyrgyzstan", "Syria", "Sao Tome and Principe", "Kosovo", "Palestine",
    "Republic of Korea", "Democratic People's Republic of Korea", "Burma", "Turkiye",
    "Bosnia and Herzegovina", "DR Congo", "Northern Ireland",
]

# Search and model terms that occur in the invented prose.
PHRASES = ["that the", "heit"]
HEADINGS = ["standard"]
WANTED_HEADINGS = ["asia", "Europe", "NATION_0", "Nowhere"]
INCLUDE_WEIGHTS = {"that": 0.5, "heit": 1.0, "ouch": -0.5, "tion": 0.25, "ing": -0.25}
MATURE_WEIGHTS = {"er": 0.5, "on": -0.5, "hein": 1.0}
VOCABULARY = [
    "that", "heit", "the", "and", "ing", "tion", "ouch", "ent", "der", "und", "que",
    "con", "aux", "keit", "los", "est",
]
AUTHOR_ORDER = ["l_linenumber", "l_suppkey", "l_partkey"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def include_model() -> TermModel:
    return TermModel(INCLUDE_WEIGHTS)


def mature_model() -> TermModel:
    return TermModel(MATURE_WEIGHTS)


def label_weights(number: int) -> tuple[dict[str, float], float]:
    """Weights and bias of one characteristic, by rule."""
    size = len(VOCABULARY)
    weights = {VOCABULARY[number % size]: 1.0}
    against = VOCABULARY[(5 * number + 3) % size]
    weights[against] = weights.get(against, 0.0) - 0.5
    return weights, -0.5 * (number % 4)


def characteristics_model() -> TermLabels:
    rules = [label_weights(i) for i in range(len(CHARACTERISTICS))]
    return TermLabels(
        VOCABULARY,
        [[weights.get(term, 0.0) for term in VOCABULARY] for weights, _ in rules],
        [bias for _, bias in rules],
    )


def title_of(text: Column) -> Column:
    """The first line."""
    return F.substring_index(text, "\n", 1)


def abstract_of(text: Column) -> Column:
    """What follows the first line; NULL when there is one line only."""
    newline = F.instr(text, F.lit("\n"))
    return F.when(newline > 0, F.substr(text, newline + 1))


def prose(spark: SparkSession, folder: str, costly: bool = False) -> DataFrame:
    """Documents as articles; ``costly`` spreads a small table over the cores."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    documents = spread(documents) if costly else documents
    return documents.select(
        F.col("doc_id").alias("pmid"),
        title_of(F.col("text")).alias("title"),
        abstract_of(F.col("text")).alias("abstract"),
        "lang",
        "source",
    )


def nations(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array(*[F.lit(c) for c in COUNTRIES])
    country = F.element_at(names, F.col("n_nationkey") + 1)
    return table(spark, folder, "nation").select("n_nationkey", country.alias("country"))


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")
    )


def institutions(spark: SparkSession, folder: str) -> DataFrame:
    sited = suppliers(spark, folder).join(nations(spark, folder), "n_nationkey", "left")
    return sited.drop("n_nationkey")


def with_journal_country(orders: DataFrame, folder: str) -> DataFrame:
    """Add the customer's country as the journal country, one small join after the other."""
    spark = orders.sparkSession
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    homes = nations(spark, folder).withColumnRenamed("country", "journal_country")
    rows = orders.join(customers, "o_custkey", "left").join(homes, "n_nationkey", "left")
    return rows.drop("n_nationkey", "o_custkey")


def bare_lines(spark: SparkSession, folder: str, costly: bool = False) -> DataFrame:
    """One row per author position."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", *AUTHOR_ORDER, "l_returnflag", "l_linestatus"
    )
    return spread(lines) if costly else lines


def with_sites(lines: DataFrame, folder: str, sites: DataFrame) -> DataFrame:
    """Add the institution and its country to rows with an ``l_suppkey``."""
    sited = lines.join(sites, "l_suppkey", "left")
    return sited.join(nations(lines.sparkSession, folder), "n_nationkey", "left").drop("n_nationkey")


def author_lines(spark: SparkSession, folder: str, costly: bool = False) -> DataFrame:
    """One row per author position with the institution and its country."""
    return with_sites(bare_lines(spark, folder, costly), folder, suppliers(spark, folder))


def second_countries(spark: SparkSession, folder: str) -> DataFrame:
    return nations(spark, folder).select(
        F.col("n_nationkey").alias("l_linenumber"), F.col("country").alias("country_2")
    )


def country_text(of: Callable[[str], Column] = F.col) -> Column:
    """An affiliation that names one country, or two when the line is open."""
    text = F.concat(
        F.lit("Dept "), of("l_partkey"), F.lit(", "), of("s_name"), F.lit(", "), of("country")
    )
    both = F.concat(text, F.lit(" and "), of("country_2"))
    return F.when(of("l_linestatus") == "O", both).otherwise(text)


def city_text(of: Callable[[str], Column] = F.col) -> Column:
    """An affiliation that names two institutions and no country."""
    other = F.concat(F.lit("Supplier#"), F.lpad(of("l_linenumber").cast("string"), 9, "0"))
    return F.concat(
        F.lit("Unit "), of("l_partkey"), F.lit(", "), other, F.lit(", "), of("s_name")
    )


def tail_text(of: Callable[[str], Column] = F.col) -> Column:
    """An affiliation known by its last two words, as a whole, or not at all."""
    tail = F.concat(F.lit("Dept "), of("l_partkey"), F.lit(" of Campus "), of("l_suppkey"))
    whole = F.concat(F.lit("Institute "), of("l_suppkey"), F.lit(" Old East Wing"))
    nowhere = F.concat(F.lit("Nowhere "), of("l_partkey"))
    return (
        F.when(of("l_linestatus") == "F", tail)
        .when(of("l_linenumber") <= 3, whole)
        .otherwise(nowhere)
    )


def mixed_text(of: Callable[[str], Column] = F.col) -> Column:
    """Each of the texts above by the line's flag; ``of`` gives the line's fields."""
    return (
        F.when(of("l_returnflag") == "A", country_text(of))
        .when(of("l_returnflag") == "N", city_text(of))
        .otherwise(tail_text(of))
    )


def trade_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a text that names a part, a customer and a supplier, and words close to names."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    buyers = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    people = table(spark, folder, "customer").select("c_custkey", "c_name")
    # Orders are fewer than their lines, so the buyers' names are joined to them.
    buyers = buyers.join(people, "c_custkey", "left").drop("c_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", *AUTHOR_ORDER)
    named = lines.join(parts, "l_partkey", "left").join(buyers, "l_orderkey", "left")
    sold = named.join(suppliers(spark, folder).drop("n_nationkey"), "l_suppkey", "left")
    text = F.concat(
        F.lit("Lot of "), F.col("p_name"), F.lit(" and other "), F.col("p_name"), F.lit("s to "), F.col("c_name"),
        F.lit(", from ("), F.col("s_name"), F.lit(") not Supplier#"), F.col("l_linenumber"),
    )
    return sold.select("l_orderkey", *AUTHOR_ORDER, text.alias("text"))


def misspelt(name: Column, number: Column) -> Column:
    """The name as someone might type it; what is wrong with it follows the number."""
    middle = F.greatest(F.floor(F.char_length(name) / 2).cast("int"), F.lit(1))
    head, rest = F.substr(name, F.lit(1), middle), F.substr(name, middle + 1)
    one_less, one_more = F.concat(head, F.substr(rest, F.lit(2))), F.concat(head, F.lit("x"), rest)
    other = F.concat(head, F.lit("y"), F.substr(rest, F.lit(2)))
    kinds = [
        name, one_less, one_more, other, F.concat(F.lit("z"), one_less), F.concat(F.substr(one_more, F.lit(2)), F.lit(" ")),
        F.upper(F.translate(name, "aeiou", "áèïôü")), F.concat(F.lit("qqq"), name),
    ]
    return F.get(F.array(*kinds), F.pmod(number, F.lit(len(kinds))).cast("int"))


def two_country_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = author_lines(spark, folder, costly=True)
    return lines.join(second_countries(spark, folder), "l_linenumber", "left")


def affiliation_lines(spark: SparkSession, folder: str, text: Column) -> DataFrame:
    return two_country_lines(spark, folder).withColumn("affil", text)


def gazetteers(spark: SparkSession, folder: str) -> Gazetteers:
    """Country names, and the institutions as cities and as places."""
    sites = institutions(spark, folder)
    cities = sites.select(
        F.col("s_name").alias("city"),
        F.concat("s_name", F.lit(", "), "country").alias("address"),
    )
    campuses = sites.select(
        F.concat(F.lit("Campus "), "l_suppkey").alias("place"),
        F.concat(F.lit("Campus Road, "), "country").alias("address"),
    )
    wings = sites.select(
        F.concat(F.lit("Institute "), "l_suppkey", F.lit(" Old East Wing")).alias("place"),
        F.col("country").alias("address"),
    )
    names = name_table(nations(spark, folder), "country")
    return Gazetteers(names, cities, campuses.unionByName(wings))


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Everything an article record takes from its line items, one row per order.

    The lists are the article's own authors, subjects and references, which one record
    holds as a whole. Names of institutions and countries are looked up, and the affiliations
    written out, behind the shuffles, which move the keys; institutions too large to broadcast
    would need a shuffle of their own there and are joined first.
    """
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_size"
    )
    lines, sites = bare_lines(spark, folder, costly=True), suppliers(spark, folder)
    if measured_bytes(sites) <= BROADCAST_BYTES:
        moved = lines.join(parts, "l_partkey", "left").repartition("l_orderkey")
        lines = with_sites(moved, folder, F.broadcast(sites))
    else:
        lines = with_sites(lines, folder, sites).join(parts, "l_partkey", "left")
    lines = lines.join(F.broadcast(second_countries(spark, folder)), "l_linenumber", "left")
    subjects = ["p_name", "p_type", "p_size", "l_returnflag", "l_linestatus"]
    values = ["s_name", "country", "country_2", *subjects]
    listed = ordered_entries(lines, "l_orderkey", AUTHOR_ORDER, values, "lines")

    def written(x: Column) -> Column:
        own = [x.getField(n).alias(n) for n in [*AUTHOR_ORDER, "s_name"]]
        rest = [x.getField(n).alias(n) for n in subjects]
        return F.struct(*own, mixed_text(x.getField).alias("affil"), *rest)

    # Sorted once more, since equal lines are told apart by their texts.
    return listed.withColumn("lines", F.sort_array(F.transform("lines", written)))


def nested(
    citation: dict[str, Column], article: dict[str, Column], details: dict[str, Column]
) -> Column:
    """A nested record from its parts; absent parts stay out of the XML."""

    def struct(parts: dict[str, Column]) -> Column:
        return F.struct(*[column.alias(name) for name, column in parts.items()])

    inner = {**citation, **({"Article": struct(article)} if article else {})}
    parts = {"MedlineCitation": struct(inner)}
    if details:
        parts["PubmedData"] = struct(details)
    return struct(parts)


def boxed(name: str, value: Column) -> Column:
    return F.struct(value.alias(name))


def date_parts(day: Column, month_offset: int = 0) -> list[Column]:
    """Year, month and day as unpadded text fields."""
    return [
        F.year(day).cast("string").alias("Year"),
        (F.month(day) + month_offset).cast("string").alias("Month"),
        F.dayofmonth(day).cast("string").alias("Day"),
    ]


def subject(line: Column) -> Column:
    """A subject heading: the part type, or an animal for small promotional parts."""
    animal = (line.getField("p_type") == "PROMO") & (line.getField("p_size") <= 5)
    return F.when(animal, F.lit("Mice")).otherwise(F.initcap(line.getField("p_type")))


def article_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as an article record in XML text."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("pmid"), "o_custkey", F.col("o_orderdate").cast("date").alias("day")
    )
    rows = with_journal_country(spread(orders), folder)
    rows = rows.join(prose(spark, folder), "pmid", "left")
    rows = rows.join(
        article_lines(spark, folder).withColumnRenamed("l_orderkey", "pmid"), "pmid", "left"
    )
    key, lines = F.col("pmid").cast("string"), F.col("lines")
    author = F.transform(
        lines,
        lambda x: F.struct(
            x.getField("s_name").alias("LastName"),
            F.concat(F.lit("P"), x.getField("l_partkey")).alias("ForeName"),
            F.array(boxed("Affiliation", x.getField("affil"))).alias("AffiliationInfo"),
        ),
    )
    location = F.array(
        F.struct(F.concat(F.lit("10.1000/"), key).alias("_VALUE"), F.lit("doi").alias("_EIdType")),
        F.struct(F.concat(F.lit("S"), key).alias("_VALUE"), F.lit("pii").alias("_EIdType")),
    )
    words = F.transform(lines, lambda x: x.getField("p_name"))
    headings = F.transform(lines, lambda x: boxed("DescriptorName", subject(x)))
    cited = F.transform(
        lines,
        lambda x: boxed(
            "ArticleIdList",
            boxed("ArticleId", F.array(boxed("_VALUE", x.getField("l_partkey").cast("string")))),
        ),
    )
    history = F.array(F.struct(F.lit("pubmed").alias("_PubStatus"), *date_parts(F.col("day"))))
    has_lines = lines.isNotNull()
    record = nested(
        {
            "PMID": boxed("_VALUE", key),
            "MedlineJournalInfo": boxed("Country", F.col("journal_country")),
            "KeywordList": F.when(has_lines, F.array(boxed("Keyword", words))),
            "MeshHeadingList": F.when(has_lines, boxed("MeshHeading", headings)),
        },
        {
            "ELocationID": location,
            "ArticleTitle": F.col("title"),
            "Abstract": F.when(
                F.col("abstract").isNotNull(), boxed("AbstractText", F.array("abstract"))
            ),
            "ArticleDate": F.array(F.struct(*date_parts(F.col("day")))),
            "PublicationTypeList": boxed("PublicationType", F.array(F.lit("Journal Article"))),
            "Language": F.when(F.col("lang").isNotNull(), F.array("lang")),
            "Journal": boxed("Title", F.col("source")),
            "AuthorList": F.when(has_lines, boxed("Author", author)),
        },
        {
            "History": boxed("PubMedPubDate", history),
            "ReferenceList": F.when(has_lines, F.array(boxed("Reference", cited))),
        },
    )
    return rows.select(to_xml(record).alias("xml"))


def to_xml(record: Column) -> Column:
    return F.to_xml(record, {"rowTag": "PubmedArticle", "indent": ""})
