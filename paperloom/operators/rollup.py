"""Per-article country roll-ups, fill country and income-group flags."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants
from paperloom.functions.terms import contains_any
from paperloom.functions.text import (
    as_flag,
    blank_nan_list,
    lower_rendered,
    render_list,
)
from paperloom.operators.lookup import salt_of


def list_columns(df: DataFrame, countries: str = "affil_countries") -> DataFrame:
    """Distinct set, first and last of an ordered country list already in the row."""
    items = F.col(countries)
    return df.withColumns(
        {
            "affil_countries_unique": F.array_sort(F.array_distinct(items)),
            "affil_first_country": F.try_element_at(items, F.lit(1)),
            "affil_last_country": F.try_element_at(items, F.lit(-1)),
        }
    )


def rollup_summary(
    rows: DataFrame, key: str, order: Sequence[str], country: str = "country"
) -> DataFrame:
    """First, last and distinct countries per article from one row per mention.

    Every aggregate merges, so map tasks send one small buffer per article and an article
    with very many rows costs no more than others.
    """
    place = F.struct(*order)
    has_unknown = F.max(F.col(country).isNull())
    unknown = F.array(F.lit(None).cast("string"))
    known = F.sort_array(F.collect_set(country))
    return rows.groupBy(key).agg(
        F.when(has_unknown, F.concat(known, unknown)).otherwise(known).alias(
            "affil_countries_unique"
        ),
        F.min_by(country, place).alias("affil_first_country"),
        F.max_by(country, place).alias("affil_last_country"),
    )


def ordered_entries(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    values: Sequence[str],
    into: str = "entries",
    salts: int | None = None,
) -> DataFrame:
    """Per key, the list of its rows as structs of ``order`` and ``values``, in order.

    The rows are moved once. With ``salts`` the rows of a key are first sorted in that many
    parts, in different tasks, and the sorted parts are then merged, which moves everything
    a second time: for keys with very many rows each. The final list is one cell, as large as
    the record it belongs to; where only first, last or distinct values are wanted use
    ``rollup_summary``, which builds no list.
    """
    entry = F.struct(*order, *values)
    if salts is None:
        return rows.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias(into))
    parts = (
        rows.withColumn("__part", salt_of(list(order), salts))
        .groupBy(key, "__part")
        .agg(F.sort_array(F.collect_list(entry)).alias("__items"))
    )
    merged = F.sort_array(F.flatten(F.collect_list("__items")))
    return parts.groupBy(key).agg(merged.alias(into))


def rollup_lists(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    country: str = "country",
    salts: int = 8,
) -> DataFrame:
    """The full ordered country list per article, with distinct set, first and last."""
    entries = ordered_entries(rows, key, order, [country], "__entries", salts)
    countries = F.transform("__entries", lambda entry: entry.getField(country))
    return list_columns(entries.select(key, countries.alias("affil_countries")))


def rendered(df: DataFrame) -> DataFrame:
    """Both country lists as text, for the sink; a single missing country becomes NULL."""
    return df.withColumns(
        {
            name: blank_nan_list(render_list(F.col(name)))
            for name in ("affil_countries", "affil_countries_unique")
            if name in df.columns
        }
    )


def fill_country(
    df: DataFrame,
    order: Sequence[str] = ("first", "last", "journal"),
    normalise_fill: bool = False,
) -> DataFrame:
    """First known country along ``order``; ``("first", "journal")`` skips the last author."""
    sources = {
        "first": F.col("affil_first_country"),
        "last": F.col("affil_last_country"),
        "journal": F.col("journal_country"),
    }
    filled = df.withColumn("affil_fill_country", F.coalesce(*[sources[name] for name in order]))
    return normalise_country(filled, "affil_fill_country") if normalise_fill else filled


def normalise_country(
    df: DataFrame,
    column: str = "affil_first_country",
    renames: Mapping[str, str] = constants.COUNTRY_RENAMES,
) -> DataFrame:
    """Exact-match renames of one column."""
    return df.withColumn(column, F.col(column).cast("string")).replace(
        dict(renames), subset=[column]
    )


def flag_any_term(
    countries: Column, terms: Iterable[str], mode: str = "substring"
) -> Column:
    """1.0 when a term matches.

    ``substring`` searches lower-cased list text for the terms as patterns, so ``niger``
    also hits ``nigeria``. ``exact`` compares whole elements of a country list.
    """
    if mode == "substring":
        return as_flag(contains_any(countries, terms))
    if mode == "exact":
        wanted = F.array(*[F.lit(t) for t in dict.fromkeys(terms)])
        known = F.filter(countries, lambda c: c.isNotNull())
        return as_flag(F.arrays_overlap(F.transform(known, F.lower), wanted))
    raise ValueError(f"unknown mode {mode!r}")


def country_flags(
    df: DataFrame,
    lower_terms: Iterable[str] = constants.LOWER_INCOME_TERMS,
    terms: Iterable[str] = constants.LOW_MIDDLE_INCOME_TERMS,
    china_terms: Iterable[str] = constants.CHINA_TERMS,
    null_text: str = "nan",
) -> DataFrame:
    """Lower-cased country text and the three flags from the rendered distinct list."""
    text = F.col("countries_lc")
    lowered = lower_rendered(F.col("affil_countries_unique"), null_text)
    return df.withColumn("countries_lc", lowered).withColumns(
        {
            "lmic_author_flag": flag_any_term(text, ["iran", *terms]),
            "lmic_author_lower_flag": flag_any_term(text, ["iran", *lower_terms]),
            "lmic_china_flag": flag_any_term(text, china_terms),
        }
    )


def add_year(df: DataFrame, column: str = "pubmed_date") -> DataFrame:
    return df.withColumn("year", F.year(column))
