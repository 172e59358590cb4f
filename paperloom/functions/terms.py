"""Term-list expressions: alternations, prefixes and in-place name mentions."""

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import WORD


def minimal_terms(terms: Iterable[str]) -> list[str]:
    """Distinct terms without those that contain another one: containment is unchanged."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """One alternation over all terms instead of one pass per term; a dot stands for any character."""
    escaped = [r".".join(map(re.escape, term.split("."))) for term in minimal_terms(terms)]
    return text.rlike("|".join(escaped))


def any_starts_with(items: Column, prefixes: Iterable[str]) -> Column:
    """True where some list element starts with a prefix; a NULL list gives False."""
    pattern = "^(?:" + "|".join(re.escape(p) for p in prefixes) + ")"
    return F.coalesce(F.exists(items, lambda item: item.rlike(pattern)), F.lit(False))


def mention_pattern(names: Iterable[str]) -> str:
    """A pattern for whole-word mentions: leftmost first, longest name at each place.

    Names are grouped by first character, so a position that starts no name costs one
    comparison per distinct initial rather than one per name.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for name in sorted(set(names), key=lambda n: (-len(n), n)):
        groups[name[0]].append(re.escape(name[1:]))
    body = "|".join(
        f"{re.escape(initial)}(?:{'|'.join(rest)})" for initial, rest in sorted(groups.items())
    )
    return f"(?<![{WORD}])(?:{body})(?![{WORD}])"


def mentions(text: Column, names: Mapping[str, str], case_sensitive: bool = True) -> Column:
    """Distinct canonical names mentioned in the text, in order of first mention.

    ``names`` maps each spelling to its canonical name. It is meant for a bounded list
    such as country names: the match runs in place, so no row is shuffled.
    """
    fold = (lambda s: s) if case_sensitive else str.lower
    spellings = {fold(name): canonical for name, canonical in names.items() if name}
    if not spellings:
        return F.when(text.isNotNull(), F.array().cast("array<string>"))
    subject = text if case_sensitive else F.lower(text)
    found = F.regexp_extract_all(subject, F.lit(mention_pattern(spellings)), F.lit(0))
    aliases = {name: canonical for name, canonical in spellings.items() if name != canonical}
    if aliases:
        table = F.create_map(*[F.lit(part) for pair in aliases.items() for part in pair])
        found = F.transform(found, lambda m: F.coalesce(F.try_element_at(table, m), m))
    return F.array_distinct(found)
