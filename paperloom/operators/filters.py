"""Row filters ahead of scoring."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.constants import ANIMAL_PREFIXES
from paperloom.functions.terms import any_starts_with


def is_animal_study(
    terms: Column, prefixes: Iterable[str] = ANIMAL_PREFIXES, enabled: bool = True
) -> Column:
    """True where a subject term starts with a prefix; NULL terms are not animal studies."""
    return any_starts_with(terms, prefixes) if enabled else F.lit(False)


def drop_by_term_prefix(
    df: DataFrame,
    column: str = "mesh_terms",
    prefixes: Iterable[str] = ANIMAL_PREFIXES,
    enabled: bool = True,
) -> DataFrame:
    return df.where(~is_animal_study(F.col(column), prefixes, enabled))


def scoring_candidate(animal_filter: bool = True) -> Column:
    """Articles that reach the first model: an abstract, and no animal subject term."""
    animal = is_animal_study(F.col("mesh_terms"), enabled=animal_filter)
    return F.col("abstract").isNotNull() & ~animal


def with_abstract(df: DataFrame) -> DataFrame:
    return df.where(F.col("abstract").isNotNull())

