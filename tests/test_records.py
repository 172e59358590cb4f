"""Edge cases of the nested record, read from XML files and from XML text."""

from datetime import date

import pytest

from paperloom import schemas
from paperloom.operators import quality
from paperloom.sources import articles


def record(pmid="1", article="", citation="", details=""):
    return (
        f'<PubmedArticle><MedlineCitation Status="x"><PMID Version="1">{pmid}</PMID>'
        f"<Article>{article}</Article>{citation}</MedlineCitation>"
        f"<PubmedData>{details}</PubmedData></PubmedArticle>"
    )


def author(last=None, fore=None, affils=()):
    names = (f"<LastName>{last}</LastName>" if last else "") + (
        f"<ForeName>{fore}</ForeName>" if fore else ""
    )
    places = "".join(
        f"<AffiliationInfo><Affiliation>{a}</Affiliation></AffiliationInfo>" for a in affils
    )
    return f"<Author>{names}{places}</Author>"


def entry(status, year, month, day):
    return (
        f'<PubMedPubDate PubStatus="{status}"><Year>{year}</Year><Month>{month}</Month>'
        f"<Day>{day}</Day><Hour>6</Hour></PubMedPubDate>"
    )


@pytest.fixture(params=["text", "file"])
def parse(request, spark, tmp_path):
    def run(xml, **rules):
        if request.param == "text":
            frame = spark.createDataFrame([(xml,)], "xml string")
            return articles.flatten_records(articles.records_from_text(frame, "xml"), **rules).first()
        (tmp_path / "a.xml").write_text(
            f"<PubmedArticleSet>{xml}<PubmedBookArticle><PMID>9</PMID></PubmedBookArticle>"
            "</PubmedArticleSet>"
        )
        rows = articles.read_articles(spark, str(tmp_path), **rules).collect()
        assert len(rows) == 1
        return rows[0]

    return run


DOI = '<ELocationID EIdType="doi">10.1/a</ELocationID>'
PII = '<ELocationID EIdType="pii">S1</ELocationID>'


@pytest.mark.parametrize(
    "ids, last_doi, last_id",
    [(DOI + PII, "10.1/a", None), (PII + DOI, "10.1/a", "10.1/a"), (PII, None, None), ("", None, None)],
)
def test_doi(parse, ids, last_doi, last_id):
    assert parse(record(article=ids)).doi == last_doi
    assert parse(record(article=ids), doi_rule="last_id").doi == last_id


def test_unknown_doi_rule(spark):
    with pytest.raises(ValueError):
        articles.record.doi("first")


def test_title_and_abstract(parse):
    row = parse(
        record(
            article="<ArticleTitle>p &lt; 0.05 in <i>E. coli</i></ArticleTitle><Abstract>"
            '<AbstractText Label="A">first <i>it</i> tail</AbstractText>'
            "<AbstractText>second</AbstractText></Abstract>"
        )
    )
    assert row.title == "p < 0.05 in E. coli"
    assert row.abstract == "first it tail"


def test_joined_sections(parse):
    xml = record(
        article="<Abstract><AbstractText>one</AbstractText><AbstractText>two</AbstractText></Abstract>"
    )
    assert parse(xml, join_sections=True).abstract == "one two"
    assert parse(record(), join_sections=True).abstract is None


def test_missing_parts_are_null(parse):
    row = parse(record())
    assert row.pmid == 1
    assert all(value is None for name, value in row.asDict().items() if name != "pmid")


def test_scalars_take_the_first(parse):
    row = parse(
        record(
            article="<Journal><Title>Long</Title><ISOAbbreviation>L.</ISOAbbreviation></Journal>"
            "<PublicationTypeList><PublicationType UI='D1'>Journal Article</PublicationType>"
            "<PublicationType UI='D2'>Review</PublicationType></PublicationTypeList>"
            "<Language>eng</Language><Language>ger</Language>",
            citation="<MedlineJournalInfo><Country>England</Country></MedlineJournalInfo>",
        )
    )
    assert (row.journal, row.journal_short, row.journal_country) == ("Long", "L.", "England")
    assert (row.article_type, row.lang) == ("Journal Article", "eng")


@pytest.mark.parametrize(
    "parts, expected",
    [
        ("<Year>2024</Year><Month>2</Month><Day>3</Day>", date(2024, 2, 3)),
        ("<Year>2024</Year><Month>02</Month><Day>03</Day>", date(2024, 2, 3)),
        ("<Year>2024</Year><Month>02</Month><Day>30</Day>", None),
        ("<Year>2024</Year><Month>02</Month>", None),
        ("<Year>2024</Year><Month>Feb</Month><Day>3</Day>", None),
    ],
)
def test_article_date(parse, parts, expected):
    assert parse(record(article=f"<ArticleDate>{parts}</ArticleDate>")).article_date == expected


def test_last_pubmed_entry_wins(parse):
    history = "".join(
        [
            entry("pubmed", 2020, 1, 1),
            entry("received", 2021, 1, 1),
            entry("pubmed", 2022, 5, 6),
            entry("medline", 2023, 1, 1),
        ]
    )
    assert parse(record(details=f"<History>{history}</History>")).pubmed_date == date(2022, 5, 6)


def test_group_author_makes_lists_null(parse):
    people = author("A", "B", ["x", "y"]) + "<Author><CollectiveName>G</CollectiveName></Author>"
    xml = record(article=f"<AuthorList>{people}</AuthorList>")
    row = parse(xml)
    assert row.authors is None and row.author_affils is None
    kept = parse(xml, drop_bad=True)
    assert kept.authors == ["A B"] and kept.author_affils == ["x"]


def test_author_lists_in_order(parse):
    people = author("A", "B", ["x", "y"]) + author("C", "D", ["z"])
    row = parse(record(article=f"<AuthorList>{people}</AuthorList>"))
    assert row.authors == ["A B", "C D"]
    assert row.author_affils == ["x", "z"]


def test_empty_author_list(parse):
    row = parse(record(article="<AuthorList></AuthorList>"))
    assert row.authors == [] and row.author_affils == []


def test_term_lists(parse):
    row = parse(
        record(
            citation="<KeywordList><Keyword MajorTopicYN='N'>k1</Keyword><Keyword>k2</Keyword>"
            "</KeywordList><KeywordList><Keyword>late</Keyword></KeywordList><MeshHeadingList>"
            "<MeshHeading><DescriptorName UI='D1'>Humans</DescriptorName></MeshHeading>"
            "<MeshHeading><DescriptorName>Mice</DescriptorName><QualifierName>q</QualifierName>"
            "</MeshHeading></MeshHeadingList>"
        )
    )
    assert row.keywords == ["k1", "k2"]
    assert row.mesh_terms == ["Humans", "Mice"]


def test_references(parse):
    good = (
        '<Reference><ArticleIdList><ArticleId IdType="doi">d1</ArticleId>'
        '<ArticleId IdType="pubmed">11</ArticleId></ArticleIdList></Reference>'
    )
    bare = "<Reference><Citation>c</Citation></Reference>"
    listed = record(details=f"<ReferenceList>{good}{good}</ReferenceList>")
    assert parse(listed).references_pmids == ["d1", "d1"]
    assert parse(listed, pmid_only=True).references_pmids == ["11", "11"]
    broken = record(details=f"<ReferenceList>{good}{bare}</ReferenceList>")
    assert parse(broken).references_pmids is None
    assert parse(broken, pmid_only=True).references_pmids == ["11"]


def test_problems_are_quarantined(spark):
    bad_date = record(pmid="2", details=f"<History>{entry('pubmed', 2024, 2, 30)}</History>")
    frame = spark.createDataFrame(
        [(record(),), (bad_date,), (record(pmid="x7"),)], "xml string"
    )
    rows = articles.flatten_records(
        articles.records_from_text(frame, "xml"), with_problems=True
    )
    sound, failed = quality.quarantine(rows, "problems")
    assert [r.pmid for r in sound.collect()] == [1]
    assert {tuple(r.problems) for r in failed.collect()} == {("pubmed_date",), ("pmid",)}
    counts = {r.problem: r.failed for r in quality.problem_counts(failed, "problems").collect()}
    assert counts == {"pmid": 1, "pubmed_date": 1}


def test_article_schema(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<PubmedArticleSet>{record()}</PubmedArticleSet>")
    frame = articles.read_articles(spark, str(tmp_path))
    assert ", ".join(f"{n} {k}" for n, k in frame.dtypes) == schemas.ARTICLE


def test_no_records_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<PubmedArticleSet></PubmedArticleSet>")
    assert articles.read_articles(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("xml", [None, "", "no xml", "<PubmedArticle><MedlineCitation>"])
def test_unreadable_text_is_a_problem_not_a_failure(spark, xml):
    frame = spark.createDataFrame([(xml,), (record(),)], "xml string")
    rows = articles.flatten_records(articles.records_from_text(frame, "xml"), with_problems=True)
    problem = "pmid" if xml is None else "record"
    assert {(r.pmid, tuple(r.problems)) for r in rows.collect()} == {(None, (problem,)), (1, ())}


def test_a_damaged_record_costs_only_itself(spark, tmp_path):
    def text(i):
        return f"<PubmedArticle><MedlineCitation><PMID>{i}</PMID></MedlineCitation></PubmedArticle>"

    whole = [text(i) for i in range(1, 8)]
    whole[1] = whole[1].replace("</PMID>", "")
    whole[3] = whole[3][:40]
    body = "<?xml version='1.0'?><PubmedArticleSet>" + "\n".join(whole) + "</PubmedArticleSet>"
    (tmp_path / "a.xml").write_text(body)
    (tmp_path / "b.xml").write_text("<PubmedArticleSet>" + text(9) + text(10)[:50])
    rows = articles.read_articles(spark, str(tmp_path), with_problems=True).collect()
    assert sorted(r.pmid for r in rows if not r.problems) == [1, 3, 5, 6, 7, 9]
    broken = [r for r in rows if r.problems]
    assert [r.problems for r in broken] == [["record"]] * 3
    assert all("<PubmedArticle>" in r["_corrupt_record"] for r in broken)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    text = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle>"
    (tmp_path / "a.xml").write_text("<PubmedArticleSet>" + "".join(text.format(i) for i in range(20000)) + "</PubmedArticleSet>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        frame = articles.read_articles(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() >= 4
        assert frame.select("pmid").distinct().count() == frame.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_file_is_landed_once(spark, tmp_path):
    text = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle>"
    source = tmp_path / "in"
    source.mkdir()
    for day, ids in ((1, (1, 2)), (2, (2, 3)), (3, ())):
        if ids:
            (source / f"{day}.xml").write_text("".join(map(text.format, ids)))
        articles.land_files(spark, str(source), f"{tmp_path}/landed", f"{tmp_path}/check", date(2024, 1, day))
    rows = articles.read_landed(spark, f"{tmp_path}/landed").select("pmid", "landed_on").collect()
    assert sorted((r.pmid, r.landed_on.day) for r in rows) == [(1, 1), (2, 1), (2, 2), (3, 2)]
