"""Countries of affiliation texts: country names, then cities, then place lookups.

Country names are matched in place by one pattern. Only texts that name no country go on
to the city and place tables, each distinct text once.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.terms import mentions
from paperloom.functions.text import WORD
from paperloom.operators.lookup import BROADCAST_BYTES, attach, measured_bytes, sieve
from paperloom.operators.merge import stage
from paperloom.session import work_folder

ATOM = f"[{WORD}]+|[^{WORD}]"


@dataclass(frozen=True)
class Gazetteers:
    """``cities(city, address)`` are recognised inside a text; ``places(place, address)``
    are looked up by its tail or as a whole. Both hold each key once. The countries of a
    place are those its address names."""

    countries: Mapping[str, str]
    cities: DataFrame | None = None
    places: DataFrame | None = None
    broadcast_bytes: int = BROADCAST_BYTES

    @property
    def has_fallback(self) -> bool:
        return self.cities is not None or self.places is not None

    @cached_property
    def city_bytes(self) -> int:
        """Measured once, however many batches use the gazetteers."""
        return measured_bytes(self.cities)

    @cached_property
    def place_bytes(self) -> int:
        return measured_bytes(self.places)

    @cached_property
    def begins(self) -> Callable[[Column], Column]:
        """Whether a word may be the first one of a city."""
        firsts = self.cities.select(F.get(_atoms(F.col("city")), F.lit(0)).alias("first"))
        return sieve(firsts, "first")


def _atoms(text: Column) -> Column:
    """The text cut into whole words and single other characters."""
    return F.regexp_extract_all(text, F.lit(ATOM), F.lit(0))


def extract_cities(texts: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
    """Cities mentioned in each distinct text, as ``mentions``.

    A word that some city begins with is looked up first, after a sieve inside the row; only
    from there runs of atoms are made, in the lengths of the cities beginning so, and joined to the cities on equality.
    Leftmost matches win, longer ones first, and matches do not overlap.
    """
    named = gazetteers.cities.select("city", "address", _atoms(F.col("city")).alias("atoms"))
    named = named.where(F.size("atoms") > 0)
    firsts = named.groupBy(F.get("atoms", F.lit(0)).alias("first")).agg(
        F.collect_set(F.size("atoms")).alias("lengths")
    )
    places = F.transform("atoms", lambda word, i: F.struct(i.alias("start"), word.alias("first")))
    begins = gazetteers.begins
    starts = texts.select(text, _atoms(F.col(text)).alias("atoms")).select(
        text, "atoms", F.inline(F.filter(places, lambda p: begins(p["first"])))
    )
    small = gazetteers.city_bytes <= gazetteers.broadcast_bytes
    near = starts.join(F.broadcast(firsts) if small else firsts, "first")
    grams = near.select(text, "start", "atoms", F.explode("lengths").alias("length")).select(
        text, "start", "length",
        F.array_join(F.slice("atoms", F.col("start") + 1, F.col("length")), "").alias("city"),
    )
    cities = gazetteers.cities
    hits = grams.join(F.broadcast(cities) if small else cities, "city")
    found = F.sort_array(
        F.collect_list(F.struct("start", (-F.col("length")).alias("order"), "city", "address"))
    )
    per_text = hits.groupBy(text).agg(found.alias("found"))

    def entry(hit: Column) -> Column:
        return F.struct(hit.getField("city").alias("city"), hit.getField("address").alias("address"))

    def keep(state: Column, hit: Column) -> Column:
        start, length = hit.getField("start"), -hit.getField("order")
        kept = F.concat(state.getField("kept"), F.array(entry(hit)))
        taken = F.struct((start + length).alias("next"), kept.alias("kept"))
        return F.when(start >= state.getField("next"), taken).otherwise(state)

    nothing = F.array().cast("array<struct<city:string,address:string>>")
    begin = F.struct(F.lit(0).alias("next"), nothing.alias("kept"))
    return per_text.select(
        text, F.aggregate("found", begin, keep).getField("kept").alias("mentions")
    )


def last_city(texts: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
    """Address of the last distinct city each text mentions; texts without one are absent."""
    found = extract_cities(texts, text, gazetteers)
    last = F.element_at(F.array_distinct("mentions"), F.lit(-1))
    return found.select(text, last.alias("hit")).select(
        text, F.col("hit.city").alias("city"), F.col("hit.address").alias("city_address")
    )


def tail_tokens(text: Column) -> Column:
    """The last two space-separated tokens, or the only one."""
    tokens = F.split(text, " ", -1)
    count = F.least(F.size(tokens), F.lit(2))
    return F.array_join(F.slice(tokens, -count, count), " ")


def resolve_places(texts: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
    """An address for each distinct text: last city, else its tail, else the whole text."""
    if gazetteers.cities is not None:
        resolved = texts.join(last_city(texts, text, gazetteers), text, "left")
    else:
        nothing = F.lit(None).cast("string")
        resolved = texts.withColumns({"city": nothing, "city_address": nothing})
    if gazetteers.places is None:
        return resolved.select(text, F.col("city_address").alias("address"))
    # Both keys are looked up by one join; the tail's entry goes before the whole text's.
    keys = F.when(F.col("city").isNull(), F.array(tail_tokens(F.col(text)), F.col(text)))
    asked = resolved.select(
        text, "city_address", F.posexplode_outer(keys).alias("priority", "place")
    )
    places = gazetteers.places.select("place", "address")
    if gazetteers.place_bytes <= gazetteers.broadcast_bytes:
        found = asked.join(F.broadcast(places), "place", "left")
    else:
        found = attach(asked, places, "place")
    order = F.when(F.col("address").isNotNull(), F.col("priority"))
    return found.groupBy(text).agg(
        F.coalesce(F.first("city_address"), F.min_by("address", order)).alias("address")
    )


def _or_unknown(countries: Column) -> Column:
    return F.when(F.size(countries) > 0, countries).otherwise(
        F.array(F.lit(None).cast("string"))
    )


def _settled_texts(texts: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
    """(text, countries) of distinct texts that name no country; ``[NULL]`` when unresolved."""
    return resolve_places(texts, text, gazetteers).select(
        text, _or_unknown(mentions(F.col("address"), gazetteers.countries)).alias("__found")
    )


def countries_of_texts(df: DataFrame, text: str, gazetteers: Gazetteers) -> DataFrame:
    """Add ``countries``: the countries of one text per row, ``[NULL]`` if unresolved.

    Rows whose text names a country stay where they are. Each distinct other text is resolved
    once and joined back; the rows are written once in between, so that the name pattern runs
    once per row.
    """
    named = df.withColumn("countries", mentions(F.col(text), gazetteers.countries))
    if not gazetteers.has_fallback:
        return named.withColumn("countries", _or_unknown(F.col("countries")))
    is_open = F.coalesce(F.size("countries") == 0, F.lit(False))
    named = stage(named, work_folder(df.sparkSession, "named"))
    settled = named.where(~is_open).withColumn("countries", _or_unknown(F.col("countries")))
    rest = named.where(is_open)
    found = _settled_texts(rest.select(F.col(text).alias("__text")).distinct(), "__text", gazetteers)
    joined = rest.withColumn("__text", F.col(text)).join(found, "__text", "left")
    looked_up = joined.withColumn("countries", F.coalesce("__found", _or_unknown(F.col("countries"))))
    return settled.unionByName(looked_up.drop("__text", "__found"))


def countries_of_articles(
    articles: DataFrame,
    gazetteers: Gazetteers,
    where: Column,
    affils: str = "author_affils",
    into: str = "affil_countries",
) -> DataFrame:
    """Add the ordered country list of each article that ``where`` selects.

    The list follows the authors, repeats included. A NULL affiliation list gives ``[NULL]``, an
    empty one NULL.

    The articles are read once: the name pattern runs over every affiliation once and the result
    is written with the article. Articles whose affiliations all name a country are settled
    there. Of the others only narrow rows, one per affiliation without a country, are resolved
    and put together again per article.
    """
    wanted = F.coalesce(where, F.lit(False))
    named = F.transform(
        F.when(wanted, F.col(affils)), lambda a: mentions(a, gazetteers.countries)
    )
    unknown = F.array(F.lit(None).cast("string"))
    in_row = F.flatten(F.transform("__named", _or_unknown))
    listed = (
        F.when(F.col("__wanted") & F.col(affils).isNull(), unknown)
        .when(F.col("__wanted") & (F.size(affils) > 0), in_row)
    )
    helpers = ["__named", "__wanted"]
    if not gazetteers.has_fallback:
        matched = articles.withColumns({"__named": named, "__wanted": wanted})
        return matched.withColumn(into, listed).drop(*helpers)
    matched = articles.withColumns({"__named": named, "__wanted": wanted})
    matched = stage(matched, work_folder(articles.sparkSession, "named"))
    is_open = F.coalesce(F.exists("__named", lambda c: F.size(c) == 0), F.lit(False))
    settled = matched.where(~is_open).withColumn(into, listed).drop(*helpers)
    key = F.concat_ws(":", "pmid", F.xxhash64(affils).cast("string"))
    rest = matched.where(is_open).withColumn("__key", key)
    pairs = F.arrays_zip(F.col(affils).alias("affil"), F.col("__named").alias("named"))
    entries = (
        rest.select("__key", pairs.alias("__pairs"))
        .dropDuplicates(["__key"])
        .select("__key", F.posexplode("__pairs").alias("__pos", "__pair"))
        .select("__key", "__pos", F.col("__pair.affil").alias("__affil"), F.col("__pair.named").alias("__named"))
    )
    nameless = F.when(F.size("__named") == 0, F.col("__affil"))
    texts = entries.select(nameless.alias("__affil")).where(F.col("__affil").isNotNull()).distinct()
    found = _settled_texts(texts, "__affil", gazetteers)
    joined = attach(entries.withColumn("__affil", nameless), found, "__affil")
    entry = F.coalesce("__found", _or_unknown(F.col("__named")))
    ordered = F.sort_array(F.collect_list(F.struct("__pos", entry.alias("countries"))))
    lists = joined.groupBy("__key").agg(
        F.flatten(F.transform(ordered, lambda x: x.getField("countries"))).alias(into)
    )
    put_together = rest.join(lists, "__key", "left").drop("__key", *helpers)
    return settled.unionByName(put_together)
