"""Scalar expressions on text, flags and rendered lists."""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"


def feature_text(title: Column, abstract: Column, null_text: str = "nan") -> Column:
    """Title and abstract as one scoring text; a NULL part reads as ``null_text``."""
    missing = F.lit(null_text)
    return F.concat(F.coalesce(title, missing), F.lit(" "), F.coalesce(abstract, missing))


def strip_inline_tags(text: Column) -> Column:
    """Drop inline formatting tags only, so that literal ``<`` in prose is kept."""
    return F.regexp_replace(text, r"</?(?:i|b|u|sub|sup)>", "")


def _quoted(item: Column) -> Column:
    escaped = F.replace(item, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(item.contains("'") & ~item.contains('"'), double).otherwise(single)


def render_list(items: Column) -> Column:
    """A list as ``['A', 'B']``; NULL elements read as ``nan``."""
    parts = F.transform(items, lambda item: F.coalesce(_quoted(item), F.lit("nan")))
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def blank_nan_list(rendered: Column) -> Column:
    """A rendered list holding a single missing element becomes NULL."""
    return F.nullif(rendered, F.lit("[nan]"))


def lower_rendered(rendered: Column, null_text: str = "nan") -> Column:
    """Lower-cased list text for the flags; NULL reads as ``null_text``."""
    return F.lower(F.coalesce(rendered, F.lit(null_text)))


def zero_filled(flag: Column) -> Column:
    """An integer flag in which NULL counts as 0."""
    return F.coalesce(flag, F.lit(0)).cast("int")


def as_flag(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0; never NULL."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def slashed_date(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")
