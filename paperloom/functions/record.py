"""Expressions that flatten one nested record into article columns.

All of them are built-in expressions over ``MedlineCitation`` and ``PubmedData``. The
``try_`` and ``get`` forms keep a damaged record from failing the job under ANSI mode.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import strip_inline_tags

CITATION = "MedlineCitation"
DETAILS = "PubmedData"


def _article(path: str) -> Column:
    return F.col(f"{CITATION}.Article.{path}")


def _empty(like: Column) -> Column:
    """``like`` with NULL read as an empty list of the same type."""
    return F.coalesce(like, F.filter(F.array(F.get(like, F.lit(0))), lambda _: F.lit(False)))


def all_or_null(
    items: Column, value: Callable[[Column], Column], drop_bad: bool = False
) -> Column:
    """The value of every item; NULL when any is missing, or without it if ``drop_bad``."""
    values = F.transform(items, value)
    if drop_bad:
        return F.filter(values, lambda v: v.isNotNull())
    return F.when(~F.exists(values, lambda v: v.isNull()), values)


def calendar_date(node: Column) -> Column:
    """Year, month and day strings as a date; NULL when missing or not a real day."""
    parts = [node.getField(name) for name in ("Year", "Month", "Day")]
    present = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.when(present, F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d"))


def pmid_text() -> Column:
    return F.col(f"{CITATION}.PMID._VALUE")


def pmid() -> Column:
    return pmid_text().try_cast("bigint")


def doi(rule: str = "last_doi") -> Column:
    """The last DOI, or with ``last_id`` the last location id if that is a DOI."""
    ids = _article("ELocationID")
    if rule == "last_doi":
        ids = F.filter(ids, lambda e: e.getField("_EIdType") == "doi")
    elif rule != "last_id":
        raise ValueError(f"unknown doi rule {rule!r}")
    last = F.try_element_at(ids, F.lit(-1))
    return F.when(last.getField("_EIdType") == "doi", last.getField("_VALUE"))


def title() -> Column:
    return strip_inline_tags(_article("ArticleTitle"))


def abstract(join_sections: bool = False) -> Column:
    sections = _article("Abstract.AbstractText")
    if join_sections:
        known = F.filter(sections, lambda s: s.isNotNull())
        return strip_inline_tags(F.when(F.size(known) > 0, F.array_join(known, " ")))
    return strip_inline_tags(F.get(sections, F.lit(0)))


def article_date() -> Column:
    return calendar_date(F.get(_article("ArticleDate"), F.lit(0)))


def _pubmed_entry() -> Column:
    history = F.col(f"{DETAILS}.History.PubMedPubDate")
    entries = F.filter(history, lambda h: h.getField("_PubStatus") == "pubmed")
    return F.try_element_at(entries, F.lit(-1))


def pubmed_date() -> Column:
    return calendar_date(_pubmed_entry())


def article_type() -> Column:
    return F.get(_article("PublicationTypeList.PublicationType"), F.lit(0))


def lang() -> Column:
    return F.get(_article("Language"), F.lit(0))


def journal() -> Column:
    return _article("Journal.Title")


def journal_short() -> Column:
    return _article("Journal.ISOAbbreviation")


def journal_country() -> Column:
    return F.col(f"{CITATION}.MedlineJournalInfo.Country")


def _author_values(value: Callable[[Column], Column], drop_bad: bool) -> Column:
    people = _article("AuthorList")
    everyone = _empty(people.getField("Author"))
    return F.when(people.isNotNull(), all_or_null(everyone, value, drop_bad))


def authors(drop_bad: bool = False) -> Column:
    """Family and given name of each author; one nameless author makes the list NULL."""
    return _author_values(
        lambda a: F.concat(a.getField("LastName"), F.lit(" "), a.getField("ForeName")), drop_bad
    )


def author_affils(drop_bad: bool = False) -> Column:
    """First affiliation of each author; one author without any makes the list NULL."""
    return _author_values(
        lambda a: F.get(a.getField("AffiliationInfo"), F.lit(0)).getField("Affiliation"),
        drop_bad,
    )


def keywords() -> Column:
    first = F.get(F.col(f"{CITATION}.KeywordList"), F.lit(0))
    return F.when(first.isNotNull(), _empty(first.getField("Keyword")))


def mesh_terms() -> Column:
    listed = F.col(f"{CITATION}.MeshHeadingList")
    headings = _empty(listed.getField("MeshHeading"))
    return F.when(
        listed.isNotNull(), all_or_null(headings, lambda h: h.getField("DescriptorName"))
    )


def references_pmids(pmid_only: bool = False) -> Column:
    """First id of each reference; one reference without ids makes the list NULL.

    With ``pmid_only`` the first id of PubMed type is taken instead, and references
    that have none are left out.
    """
    first = F.get(F.col(f"{DETAILS}.ReferenceList"), F.lit(0))
    references = _empty(first.getField("Reference"))

    def reference_id(reference: Column) -> Column:
        ids = reference.getField("ArticleIdList").getField("ArticleId")
        if pmid_only:
            ids = F.filter(ids, lambda i: i.getField("_IdType") == "pubmed")
        return F.get(ids, F.lit(0)).getField("_VALUE")

    return F.when(first.isNotNull(), all_or_null(references, reference_id, drop_bad=pmid_only))


def problems() -> Column:
    """Names of the fields that hold something unusable; empty for a sound record."""
    bad_id = pmid().isNull()
    bad_date = _pubmed_entry().isNotNull() & pubmed_date().isNull()
    return F.array_compact(
        F.array(F.when(bad_id, F.lit("pmid")), F.when(bad_date, F.lit("pubmed_date")))
    )
