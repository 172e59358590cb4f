"""The library's functions for callers who write SQL only."""

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from paperloom import constants
from paperloom.functions.terms import mention_pattern, minimal_terms


def _literal(text: str) -> str:
    """A SQL string; backslashes and quotes are written so that the parser gives them back."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _alternation(terms: Iterable[str]) -> str:
    """As ``contains_any``: a dot stands for any character, everything else for itself."""
    quoted = ["".join("\\" + c if c in "()[]{}*+?^$|\\-" else c for c in term) for term in minimal_terms(terms)]
    return "|".join(quoted) or "(?!)"


def register_functions(
    spark: SparkSession,
    names: Mapping[str, str],
    low_middle_terms: Iterable[str] = constants.LOW_MIDDLE_INCOME_TERMS,
    lower_terms: Iterable[str] = constants.LOWER_INCOME_TERMS,
) -> None:
    """Make the country functions known to the session's SQL.

    ``country_mentions(text)`` gives the distinct countries a text names, in order, under their
    canonical names. ``affiliation_countries(text)`` is a table of (position, country), without
    rows for a text that names none. ``lmic_flag(text)``, ``lmic_lower_flag(text)`` and
    ``china_flag(text)`` are 1.0 or 0.0 for a text of countries in any case. NULL texts have no
    countries and flag 0. All are SQL expressions, so the optimizer sees through them; ``names``
    is a short list, spelling to name, and becomes one pattern.
    """
    pattern = _literal(mention_pattern(names)) if names else _literal("(?!)")
    aliases = [f"{_literal(spelling)}, {_literal(name)}" for spelling, name in names.items() if spelling != name]
    canonical = f"coalesce(try_element_at(map({', '.join(aliases)}), m), m)" if aliases else "m"
    found = f"array_distinct(transform(regexp_extract_all(text, {pattern}, 0), m -> {canonical}))"
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    spark.sql(f"{create} country_mentions(text STRING) RETURNS ARRAY<STRING> RETURN {found}")
    spark.sql(
        f"{create} affiliation_countries(text STRING) RETURNS TABLE(position INT, country STRING) "
        f"RETURN SELECT pos + 1, col FROM posexplode({found})"
    )
    flags = {"lmic_flag": low_middle_terms, "lmic_lower_flag": lower_terms, "china_flag": ["china"]}
    for name, terms in flags.items():
        test = f"coalesce(lower(text) RLIKE {_literal(_alternation(terms))}, false)"
        spark.sql(f"{create} {name}(text STRING) RETURNS DOUBLE RETURN CAST({test} AS DOUBLE)")
