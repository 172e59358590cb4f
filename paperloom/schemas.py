"""Schemas of the nested record, the flat article and the main table."""

from paperloom.constants import CHARACTERISTICS, MAIN_COLUMNS

RECORD_TAG = "PubmedArticle"

# Title and abstract are strings, not structs, so that inline markup inside them survives.
RECORD = """
MedlineCitation struct<
  PMID: struct<_VALUE: string>,
  Article: struct<
    ELocationID: array<struct<_VALUE: string, _EIdType: string>>,
    ArticleTitle: string,
    Abstract: struct<AbstractText: array<string>>,
    ArticleDate: array<struct<Year: string, Month: string, Day: string>>,
    PublicationTypeList: struct<PublicationType: array<string>>,
    Language: array<string>,
    Journal: struct<Title: string, ISOAbbreviation: string>,
    AuthorList: struct<Author: array<struct<LastName: string, ForeName: string,
      AffiliationInfo: array<struct<Affiliation: string>>>>>>,
  MedlineJournalInfo: struct<Country: string>,
  KeywordList: array<struct<Keyword: array<string>>>,
  MeshHeadingList: struct<MeshHeading: array<struct<DescriptorName: string>>>>,
PubmedData struct<
  History: struct<PubMedPubDate: array<struct<_PubStatus: string, Year: string,
    Month: string, Day: string>>>,
  ReferenceList: array<struct<Reference: array<struct<
    ArticleIdList: struct<ArticleId: array<struct<_VALUE: string, _IdType: string>>>>>>>>
"""

ARTICLE = (
    "pmid bigint, doi string, title string, abstract string, article_date date, "
    "pubmed_date date, article_type string, lang string, journal string, "
    "journal_short string, journal_country string, authors array<string>, "
    "author_affils array<string>, keywords array<string>, mesh_terms array<string>, "
    "references_pmids array<string>"
)
ARTICLE_SCORED = ARTICLE + ", feature string, include int"

_ARTICLE_TYPES = dict(part.split(" ") for part in ARTICLE.split(", "))
_MAIN_TYPES = {
    **_ARTICLE_TYPES,
    "year": "int",
    "include": "int",
    "mature": "int",
    "mesh_terms": "string",
    "references_pmids": "string",
    "affil_countries": "string",
    "affil_countries_unique": "string",
    "affil_first_country": "string",
    "affil_last_country": "string",
    "affil_fill_country": "string",
    "countries_lc": "string",
    "lmic_author_flag": "double",
    "lmic_author_lower_flag": "double",
    "lmic_china_flag": "double",
    **dict.fromkeys(CHARACTERISTICS, "double"),
}
MAIN_TYPES = {name: _MAIN_TYPES[name] for name in MAIN_COLUMNS}
MAIN = ", ".join(f"{name} {kind}" for name, kind in MAIN_TYPES.items())
