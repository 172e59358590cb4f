"""The catalog's queries as plain SQL over the same tables."""

from paperloom import constants, schemas
from paperloom.plans import catalog, tables
from paperloom.sources.gazetteers import ALIASES

NEWLINE = "chr(10)"
TITLE = f"split_part(text, {NEWLINE}, 1)"
ABSTRACT = (
    f"CASE WHEN strpos(text, {NEWLINE}) > 0 THEN substr(text, strpos(text, {NEWLINE}) + 1) END"
)
PROSE = f"SELECT doc_id AS pmid, {TITLE} AS title, {ABSTRACT} AS abstract, lang, source FROM documents"
FEATURE = "coalesce(title, 'nan') || ' ' || coalesce(abstract, 'nan')"
ORDER = "l_linenumber, l_suppkey, l_partkey"


def _untagged(column: str) -> str:
    return f"regexp_replace({column}, '</?(i|b|u|sub|sup)>', '', 'g')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


NATIONS = f"SELECT n_nationkey, {_list(tables.COUNTRIES)}[n_nationkey + 1] AS country FROM nation"
SITES = (
    f"SELECT s_suppkey, s_name, country FROM supplier "
    f"LEFT JOIN ({NATIONS}) ON n_nationkey = s_nationkey"
)
SITED_LINES = (
    f"SELECT l.*, s.s_name, s.country FROM lineitem l LEFT JOIN ({SITES}) s ON s_suppkey = l_suppkey"
)


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _alternation(column: str, terms) -> str:
    return f"regexp_matches({column}, {_text('|'.join(terms))})"


def _score(text: str, weights: dict[str, float], bias: float = 0.0) -> str:
    """Weighted counts of non-overlapping terms in a lower-cased text."""
    parts = [
        f"{weight} * ((length({text}) - length(replace({text}, {_text(term)}, ''))) // {len(term)})"
        for term, weight in weights.items()
    ]
    return " + ".join([str(bias), *parts])


def _rounded(score: str) -> str:
    return f"round_even(1.0 / (1.0 + exp(-greatest(-700.0, least(700.0, {score})))), 0)"


def _label_columns(text: str, condition: str) -> str:
    columns = []
    for number, name in enumerate(constants.CHARACTERISTICS):
        weights, bias = tables.label_weights(number)
        label = _rounded(_score(text, weights, bias))
        columns.append(f"CASE WHEN {condition} THEN {label} END AS {name}")
    return ", ".join(columns)


def _quoted_list(value: str, order: str) -> str:
    return f"'[' || string_agg('''' || {value} || '''', ', ' ORDER BY {order}) || ']'"


def _nullable_list(value: str, order: str) -> str:
    quoted = f"coalesce('''' || {value} || '''', 'nan')"
    return f"'[' || string_agg({quoted}, ', ' ORDER BY {order}) || ']'"


SCALARS = f"""
SELECT pmid, {_untagged('title')} AS title, {_untagged('abstract')} AS abstract,
  'Journal Article' AS article_type, lang, source AS journal, upper(source) AS journal_short,
  upper(lang) AS journal_country
FROM ({PROSE})
"""

DATED = """
SELECT o_orderkey, o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS m,
  day(o_orderdate) AS d,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 31
       WHEN o_orderpriority <> '5-LOW' THEN day(o_orderdate) END AS article_day,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 30 ELSE day(o_orderdate) END AS entry_day
FROM orders
"""


def _made_date(day: str) -> str:
    return f"try_strptime(y || '-' || m || '-' || {day}, '%Y-%m-%d')"


def _line_lists(columns: str) -> str:
    return (
        f"SELECT o_orderkey AS pmid, {columns} FROM orders "
        "LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"
    )


def _when_lines(value: str, condition: str = "true") -> str:
    """NULL for an order without lines, and when some line fails the condition."""
    return f"CASE WHEN count(l_orderkey) > 0 AND bool_and({condition}) THEN {value} END"


AUTHOR_LISTS = _line_lists(
    ", ".join(
        [
            _when_lines(
                _quoted_list("'Name' || l_suppkey || ' P' || l_partkey", ORDER), "l_discount > 0"
            )
            + " AS authors",
            _when_lines(
                _quoted_list("'Lab ' || l_suppkey", ORDER),
                "l_returnflag <> 'R' OR l_linestatus <> 'O'",
            )
            + " AS author_affils",
            "CASE WHEN count(l_orderkey) > 0 THEN '[' || coalesce(string_agg('''Lab ' || l_suppkey"
            f" || '''', ', ' ORDER BY {ORDER}) FILTER (l_returnflag <> 'R' OR l_linestatus <> 'O'),"
            " '') || ']' END AS known_affils",
        ]
    )
)

TERM_LISTS = _line_lists(
    ", ".join(
        [
            _when_lines(_quoted_list("'word ' || l_suppkey", ORDER)) + " AS keywords",
            _when_lines(_quoted_list("'Term ' || l_partkey", ORDER), "l_tax > 0") + " AS mesh_terms",
            _when_lines(_quoted_list("l_partkey", ORDER)) + " AS references_any",
            _when_lines(
                _quoted_list(
                    "CASE WHEN l_returnflag = 'A' THEN '9' || l_suppkey ELSE l_partkey || '' END",
                    ORDER,
                )
            )
            + " AS references_pmids",
        ]
    )
)

DOI = f"""
WITH ids AS (
  SELECT o_orderkey, l_returnflag = 'R' AS is_doi, '10.' || l_suppkey || '/' || l_partkey AS id,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC,
      l_partkey DESC) AS back
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
)
SELECT o_orderkey AS pmid, arg_min(id, back) FILTER (is_doi) AS doi,
  max(CASE WHEN back = 1 AND is_doi THEN id END) AS doi_last_id
FROM ids GROUP BY o_orderkey
"""

LINE = f"l_orderkey, {ORDER}"
COUNTRY_LIST = """
CASE WHEN l_linestatus = 'O' AND c2.country <> l.country
  THEN '[''' || l.country || ''', ''' || c2.country || ''']'
  ELSE '[''' || l.country || ''']' END
"""
ONE_COUNTRY = "'[''' || l.country || ''']'"
PLACED = f"FROM ({SITED_LINES}) l JOIN ({NATIONS}) c2 ON c2.n_nationkey = l_linenumber"
# A second mention of the same institution leaves the first one as the last new name.
CITY_LIST = ONE_COUNTRY
TAIL_LIST = f"CASE WHEN l_linestatus = 'F' OR l_linenumber <= 3 THEN {ONE_COUNTRY} ELSE '[nan]' END"
MIXED_LIST = (
    f"CASE WHEN l_returnflag = 'A' THEN {COUNTRY_LIST} WHEN l_returnflag = 'N' THEN {CITY_LIST} "
    f"ELSE {TAIL_LIST} END"
)

COUNTRY_ROWS = (
    "SELECT l_orderkey AS pmid, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_returnflag <> 'R' "
    f"OR l_linestatus <> 'O' THEN country END AS country FROM ({SITED_LINES})"
)
UNIQUE_LISTS = f"""
SELECT pmid, {_nullable_list('country', 'country NULLS LAST')} AS u
FROM (SELECT DISTINCT pmid, country FROM ({COUNTRY_ROWS})) GROUP BY pmid
"""


def _end(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in tables.AUTHOR_ORDER)
    return f"(list(country ORDER BY {order}))[1]"


ROLLUP = f"""
SELECT r.pmid, nullif(any_value(l), '[nan]') AS affil_countries,
  nullif(any_value(u), '[nan]') AS affil_countries_unique,
  any_value(f) AS affil_first_country, any_value(z) AS affil_last_country
FROM (
  SELECT pmid, {_nullable_list('country', ORDER)} AS l, {_end('ASC')} AS f, {_end('DESC')} AS z
  FROM ({COUNTRY_ROWS}) GROUP BY pmid
) r JOIN ({UNIQUE_LISTS}) x ON x.pmid = r.pmid GROUP BY r.pmid
"""
JOURNALS = (
    f"SELECT c_custkey, country AS journal_country FROM customer "
    f"LEFT JOIN ({NATIONS}) ON n_nationkey = c_nationkey"
)
SUMMARY = f"""
SELECT o_orderkey AS pmid, r.* EXCLUDE (pmid), journal_country,
  lower(coalesce(affil_countries_unique, 'nan')) AS countries_lc
FROM orders LEFT JOIN ({ROLLUP}) r ON r.pmid = o_orderkey
LEFT JOIN ({JOURNALS}) ON c_custkey = o_custkey
"""


def _renamed(column: str) -> str:
    cases = " ".join(
        f"WHEN {_text(old)} THEN {_text(new)}" for old, new in constants.COUNTRY_RENAMES.items()
    )
    return f"CASE {column} {cases} ELSE {column} END"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


LC = "countries_lc"
LMIC = _flag(_alternation(LC, ["iran", *constants.LOW_MIDDLE_INCOME_TERMS]))
LOWER = _flag(_alternation(LC, ["iran", *constants.LOWER_INCOME_TERMS]))
CHINA = _flag(f"contains({LC}, 'china')")
EXACT_TERMS = ", ".join(_text(t) for t in constants.LOW_MIDDLE_INCOME_TERMS)
EXACT_FLAG = _flag(
    f"pmid IN (SELECT pmid FROM ({COUNTRY_ROWS}) WHERE lower(country) IN ({EXACT_TERMS}))"
)

LOWERED = "lower(feature)"
SCORED = f"SELECT pmid, abstract, lower({FEATURE}) AS t FROM ({PROSE})"
INCLUDE = _rounded(_score("t", tables.INCLUDE_WEIGHTS))

MERGE_TARGET = "SELECT o_orderkey AS pmid, 0::BIGINT AS detail FROM orders WHERE o_orderstatus = 'F'"
MERGE_SOURCE = (
    "SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS pmid, l_partkey AS detail "
    "FROM lineitem"
)

# The full run. Affiliation texts are spelled out, their countries come from the tables.
AFFIL = """
CASE WHEN l_returnflag = 'A' THEN 'Dept ' || l_partkey || ', ' || s_name || ', ' || l.country
       || CASE WHEN l_linestatus = 'O' THEN ' and ' || c2.country ELSE '' END
     WHEN l_returnflag = 'N' THEN 'Unit ' || l_partkey || ', Supplier#'
       || lpad(l_linenumber::VARCHAR, 9, '0') || ', ' || s_name
     WHEN l_linestatus = 'F' THEN 'Dept ' || l_partkey || ' of Campus ' || l_suppkey
     WHEN l_linenumber <= 3 THEN 'Institute ' || l_suppkey || ' Old East Wing'
     ELSE 'Nowhere ' || l_partkey END
"""
FIRST_OF_LINE = """
CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber > 3 THEN NULL
     ELSE l.country END
"""
SECOND_OF_LINE = (
    "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND c2.country <> l.country "
    "THEN c2.country END"
)
SUBJECT = """
CASE WHEN p_type = 'PROMO' AND p_size <= 5 THEN 'Mice'
     ELSE upper(p_type[1]) || lower(p_type[2:]) END
"""

FULL_RUN = f"""
lines AS (
  SELECT l_orderkey AS pmid, l_linenumber, l_suppkey, l_partkey, s_name, p_name,
    {SUBJECT} AS subject, {AFFIL} AS affil, {FIRST_OF_LINE} AS a, {SECOND_OF_LINE} AS b
  {PLACED} LEFT JOIN part ON p_partkey = l_partkey
),
lists AS (
  SELECT pmid, {_quoted_list("s_name || ' P' || l_partkey", ORDER)} AS authors,
    {_quoted_list('affil', ORDER)} AS author_affils, {_quoted_list('p_name', ORDER)} AS keywords,
    {_quoted_list('subject', ORDER)} AS mesh_terms,
    {_quoted_list('l_partkey', ORDER)} AS references_pmids,
    bool_or(regexp_matches(subject, '^({'|'.join(constants.ANIMAL_PREFIXES)})')) AS animal
  FROM lines GROUP BY pmid
),
screened AS (
  SELECT o_orderkey AS pmid, '10.1000/' || o_orderkey AS doi, {_untagged('title')} AS title,
    {_untagged('abstract')} AS abstract, o_orderdate::DATE AS day, lang, source AS journal,
    journal_country, authors, author_affils, keywords, mesh_terms, references_pmids,
    lower(coalesce({_untagged('title')}, 'nan') || ' ' || coalesce({_untagged('abstract')}, 'nan')) AS t,
    abstract IS NOT NULL AND NOT coalesce(animal, false) AS candidate
  FROM orders LEFT JOIN ({PROSE}) p ON p.pmid = o_orderkey
  LEFT JOIN lists ON lists.pmid = o_orderkey LEFT JOIN ({JOURNALS}) ON c_custkey = o_custkey
),
included AS (
  SELECT *, CASE WHEN candidate THEN {INCLUDE} ELSE 0 END::INTEGER AS include FROM screened
),
mentions AS (
  SELECT pmid, l_linenumber, l_suppkey, l_partkey, 1 AS nth, a AS country FROM lines
  UNION ALL
  SELECT pmid, l_linenumber, l_suppkey, l_partkey, 2, b FROM lines WHERE b IS NOT NULL
),
uniques AS (
  SELECT pmid, {_nullable_list('country', 'country NULLS LAST')} AS u
  FROM (SELECT DISTINCT pmid, country FROM mentions) GROUP BY pmid
),
countries AS (
  SELECT pmid, {_nullable_list('country', ORDER + ', nth')} AS l,
    (list(country ORDER BY l_linenumber, l_suppkey, l_partkey, nth))[1] AS first_one,
    (list(country ORDER BY l_linenumber DESC, l_suppkey DESC, l_partkey DESC, nth DESC))[1] AS last_one
  FROM mentions GROUP BY pmid
),
placed AS (
  SELECT i.*, CASE WHEN include = 1 THEN nullif(l, '[nan]') END AS affil_countries,
    CASE WHEN include = 1 THEN nullif(u, '[nan]') END AS affil_countries_unique,
    CASE WHEN include = 1 THEN first_one END AS first_one,
    CASE WHEN include = 1 THEN last_one END AS last_one
  FROM included i LEFT JOIN countries c ON c.pmid = i.pmid LEFT JOIN uniques q ON q.pmid = i.pmid
),
labelled AS (
  SELECT pmid, doi, title, abstract, {_day('day')} AS article_date, {_day('day')} AS pubmed_date,
    year(day)::INTEGER AS year, 'Journal Article' AS article_type, lang, journal,
    NULL::VARCHAR AS journal_short, journal_country, authors, author_affils, keywords, mesh_terms,
    references_pmids, include,
    CASE WHEN include = 1 THEN {_rounded(_score('t', tables.MATURE_WEIGHTS))} ELSE 0 END::INTEGER
      AS mature,
    affil_countries, affil_countries_unique, {_renamed('first_one')} AS affil_first_country,
    last_one AS affil_last_country,
    coalesce(first_one, last_one, journal_country) AS affil_fill_country,
    lower(coalesce(affil_countries_unique, 'nan')) AS countries_lc,
    {_label_columns('t', 'include = 1')}
  FROM placed
),
flagged AS (
  SELECT *, {LMIC} AS lmic_author_flag, {LOWER} AS lmic_author_lower_flag,
    {CHINA} AS lmic_china_flag
  FROM labelled
)
"""

SEARCH_TEXT = "lower(concat_ws(' ', title, abstract))"
ALL_PHRASES = [*constants.SEARCH_PHRASES, *tables.PHRASES]
BOTH_WORDS = "(contains(%s, 'unsupervised') AND contains(%s, 'learning'))" % (
    SEARCH_TEXT, SEARCH_TEXT,
)
LABEL_SUM = " + ".join(f"coalesce({name}, 0)" for name in constants.CHARACTERISTICS)
FIRST_DAY, LAST_DAY = catalog.WINDOW

ALIASED_NAMES = [ALIASES.get(name, name) for name in tables.ALIASED]

ORACLE: dict[str, str] = {
    "feature_text": f"SELECT pmid, {FEATURE} AS feature FROM ({PROSE})",
    "search_filter": f"""
        SELECT pmid, title FROM ({PROSE})
        WHERE {_alternation(SEARCH_TEXT, ALL_PHRASES)} OR {BOTH_WORDS} OR source = 'src3'
          OR (contains({SEARCH_TEXT}, 'keit') AND contains({SEARCH_TEXT}, 'und'))""",
    "capped_search": f"""
        SELECT o_orderkey, (SELECT count(*) FROM orders
          WHERE o_orderdate::DATE BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}') AS hit_count
        FROM orders WHERE o_orderdate::DATE BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}'
        ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT {constants.MAX_HITS}""",
    "date_window": f"""
        SELECT o_orderkey, {_day('o_orderdate')} AS day FROM orders
        WHERE o_orderdate::DATE BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}'""",
    "high_water_mark": "SELECT strftime(max(o_orderdate), '%Y/%m/%d') AS mark FROM orders",
    "batch_stats": """
        SELECT count(*) AS row_count, strftime(max(o_orderdate), '%Y/%m/%d') AS latest_date,
          count(*) FILTER (quality = 1) AS quality_count,
          count(*) FILTER (toxic = 1) AS toxic_count, count(d.doc_id) AS known_count
        FROM orders LEFT JOIN documents d ON d.doc_id = o_orderkey
        LEFT JOIN labels l ON l.doc_id = o_orderkey""",
    "xml_parse_scalars": SCALARS,
    "xml_file_scan": SCALARS,
    "xml_doi": DOI,
    "xml_dates": f"""
        SELECT o_orderkey AS pmid, {_day(_made_date('article_day'))} AS article_date,
          {_day(_made_date('entry_day'))} AS pubmed_date FROM ({DATED})""",
    "xml_author_lists": AUTHOR_LISTS,
    "xml_term_lists": TERM_LISTS,
    "scoring_candidates": f"SELECT pmid, abstract FROM ({PROSE}) WHERE abstract IS NOT NULL",
    "animal_filter": """
        SELECT o_orderkey, '[' || string_agg('''' || p_name || '''', ', ' ORDER BY p_name) || ']'
          AS mesh_terms
        FROM (SELECT DISTINCT o_orderkey, p_name FROM orders
              LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey)
        GROUP BY o_orderkey
        HAVING NOT coalesce(bool_or(p_name LIKE 'sma%' OR p_name LIKE 'red w%'), false)""",
    "score_binary": f"SELECT pmid, {INCLUDE} AS label FROM ({SCORED})",
    "score_binary_batches": f"""
        SELECT pmid, CASE WHEN abstract IS NOT NULL THEN {INCLUDE} END AS label FROM ({SCORED})""",
    "score_multilabel": f"""
        SELECT pmid, {_label_columns('t', f'{INCLUDE} = 1')} FROM ({SCORED})""",
    "label_writeback": """
        SELECT d.doc_id, lang, coalesce(quality, 0)::INTEGER AS quality,
          coalesce(toxic, 0)::INTEGER AS toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "extract_countries": f"SELECT {LINE}, {COUNTRY_LIST} AS countries {PLACED}",
    "city_fallback": f"""
        SELECT {LINE}, CASE WHEN l_returnflag = 'A' THEN {COUNTRY_LIST} ELSE {CITY_LIST} END
          AS countries {PLACED}""",
    "tail_fallback": f"SELECT {LINE}, {TAIL_LIST} AS countries {PLACED}",
    "place_resolution": f"SELECT {LINE}, {MIXED_LIST} AS countries {PLACED}",
    "country_rollup": f"""
        SELECT o_orderkey AS pmid, r.* EXCLUDE (pmid) FROM orders
        LEFT JOIN ({ROLLUP}) r ON r.pmid = o_orderkey AND o_orderstatus <> 'P'""",
    "fill_country": f"""
        SELECT pmid, coalesce(affil_first_country, affil_last_country, journal_country)
            AS affil_fill_country,
          coalesce(affil_first_country, journal_country) AS fill_without_last,
          {_renamed('coalesce(affil_first_country, affil_last_country, journal_country)')}
            AS fill_normalised
        FROM ({SUMMARY})""",
    "normalise_country": f"""
        SELECT s_suppkey AS l_suppkey, country, {_renamed('country')} AS affil_first_country
        FROM ({SITES})""",
    "country_flags": f"""
        SELECT pmid, countries_lc, {LMIC} AS lmic_author_flag, {CHINA} AS lmic_china_flag,
          {EXACT_FLAG} AS lmic_exact_flag FROM ({SUMMARY})""",
    "country_flags_lower": f"""
        SELECT pmid, {LOWER} AS lmic_author_lower_flag,
          {_flag(_alternation(LC, constants.LOWER_INCOME_TERMS_COMPAT))} AS lower_flag_compat
        FROM ({SUMMARY})""",
    "quarantine_counts": f"""
        SELECT CASE WHEN {_made_date('entry_day')} IS NULL THEN 'pubmed_date' ELSE 'none' END
          AS problem, count(*) AS failed FROM ({DATED}) GROUP BY 1""",
    "year_column": "SELECT o_orderkey, year(o_orderdate) AS year FROM orders",
    "envelope_roundtrip": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_day('o_orderdate')}
          AS o_orderdate, o_orderpriority, 0::INTEGER AS corrupt FROM orders""",
    "staging_overwrite": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""",
    "merge_insert_only": f"""
        WITH target AS ({MERGE_TARGET}), source AS ({MERGE_SOURCE})
        SELECT * FROM target UNION ALL
        SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.pmid = s.pmid)""",
    "search_exploded": """
        SELECT l_orderkey AS pmid, count(DISTINCT s_name) AS headings
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
          LEFT JOIN region ON r_regionkey = n_regionkey
        GROUP BY l_orderkey HAVING bool_or(r_name IN ('ASIA', 'EUROPE') OR n_name = 'NATION_0')""",
    "mark_from_statistics": """
        SELECT strftime(max(o_orderdate), '%Y/%m/%d') AS mark, count(*) AS row_count FROM orders""",
    "positional_writeback": f"""
        SELECT pmid AS number, CASE WHEN pmid % 5 <> 0 THEN pmid // 3 END AS pmid,
          CASE WHEN abstract IS NOT NULL THEN {INCLUDE}::BIGINT END AS include
        FROM ({SCORED})""",
    "resolution_memo": f"""
        WITH moved AS (
          SELECT country, s_suppkey % 7 = 0 AS moves FROM ({SITES})
        ), runs AS (
          SELECT count(*) AS sites, count(*) FILTER (moves AND country <> 'Peru') AS changed FROM moved
        )
        SELECT 'run 0' AS what, sites AS new, 0::BIGINT AS touched FROM runs
        UNION ALL SELECT 'run 1', sites, 0 FROM runs
        UNION ALL SELECT 'run 2', 0, 2 * changed FROM runs
        UNION ALL SELECT CASE WHEN moves THEN 'Peru' ELSE country END, 2 * count(*), 0 FROM moved GROUP BY 1""",
    "envelope_evolution": """
        SELECT o_orderkey, o_totalprice,
          CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
          CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS marks, NULL::VARCHAR AS corrupt
        FROM orders
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, '?' || o_orderkey FROM orders WHERE o_orderkey % 50 = 0""",
    "sql_surface": f"""
        WITH named AS (
          SELECT {LINE}, 1 AS position, l.country {PLACED} WHERE l_returnflag <> 'A'
          UNION ALL
          SELECT {LINE}, 2, c2.country {PLACED}
          WHERE l_returnflag <> 'A' AND l_linestatus = 'O' AND c2.country <> l.country
        )
        SELECT *, {_flag(_alternation('lower(country)', constants.LOW_MIDDLE_INCOME_TERMS))} AS lmic,
          {_flag(_alternation('lower(country)', constants.LOWER_INCOME_TERMS))} AS lmic_lower,
          {_flag("contains(lower(country), 'china')")} AS china
        FROM named""",
    "extract_names_large": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_name || '|' || c_name || '|' || s_name AS names
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN orders ON o_orderkey = l_orderkey
        LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    "stage_gates": """
        WITH shares AS (
          SELECT 'few' AS load, 25 AS share UNION ALL SELECT 'many', 10
        ), counts AS (
          SELECT load, count(*) AS rows, count(*) FILTER (o_orderkey % share = 0) AS failed
          FROM orders, shares GROUP BY load
        ), gates AS (
          SELECT load, rows, failed, (failed > 0.05 * rows)::INT AS stopped FROM counts
        )
        SELECT 'load' AS stage, load, stopped, CASE stopped WHEN 1 THEN 0 ELSE rows END AS reached FROM gates
        UNION ALL SELECT 'load', 'in_a_row', 1, 0
        UNION ALL SELECT 'publish', load, stopped, 1 - stopped FROM gates
        UNION ALL SELECT 'label', load, stopped, CASE stopped WHEN 1 THEN 0 ELSE rows - failed END FROM gates""",
    "place_spelling": f"""
        WITH sites AS (
          SELECT s_suppkey AS l_suppkey, country || ' ' || s_name AS name,
            greatest(length(country || ' ' || s_name) // 2, 1) AS m
          FROM ({SITES})
        ), typed AS (
          SELECT l_suppkey, CASE l_suppkey % 8
            WHEN 0 THEN name
            WHEN 1 THEN substr(name, 1, m) || substr(name, m + 2)
            WHEN 2 THEN substr(name, 1, m) || 'x' || substr(name, m + 1)
            WHEN 3 THEN substr(name, 1, m) || 'y' || substr(name, m + 2)
            WHEN 4 THEN 'z' || substr(name, 1, m) || substr(name, m + 2)
            WHEN 5 THEN substr(substr(name, 1, m) || 'x' || substr(name, m + 1), 2) || ' '
            WHEN 6 THEN upper(translate(name, 'aeiou', 'áèïôü'))
            ELSE 'qqq' || name END AS typed
          FROM sites
        ), near AS (
          SELECT t.typed, s.name, levenshtein(trim(lower(strip_accents(t.typed))), trim(lower(s.name))) AS distance
          FROM (SELECT DISTINCT typed FROM typed) t, (SELECT DISTINCT name FROM sites) s
        ), nearest AS (
          SELECT typed, min(distance) AS distance FROM near WHERE distance <= 2 GROUP BY typed
        ), found AS (
          SELECT typed, distance, min(name) AS name, count(*) AS ties FROM near JOIN nearest USING (typed, distance)
          GROUP BY typed, distance
        )
        SELECT l_suppkey, typed, name, distance, ties FROM typed LEFT JOIN found USING (typed)""",
    "merge_indexed": f"""
        WITH target AS ({MERGE_TARGET}), source AS ({MERGE_SOURCE})
        SELECT * FROM target UNION ALL
        SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.pmid = s.pmid)""",
    "stream_stateful_merge": """
        SELECT event_id, user_id, event_type, value,
          CASE coalesce(event_id % 4, 0) WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS stored_by
        FROM events""",
    "failure_runs": """
        WITH placed AS (
          SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '5-LOW') AS failed,
            row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place
          FROM orders
        ), islands AS (
          SELECT *, place - row_number() OVER (ORDER BY place) AS island FROM placed WHERE failed
        ), found AS (
          SELECT min_by(o_orderkey, place) AS first_key, max_by(o_orderkey, place) AS last_key, count(*) AS length
          FROM islands GROUP BY island
        )
        SELECT *, (SELECT max(length) FROM found) AS longest, (SELECT count(*) FROM orders) AS records
        FROM found WHERE length >= 5""",
    "stream_incremental_merge": "SELECT event_id, user_id, event_type, value FROM events",
    "landed_window": """
        SELECT o_orderkey AS pmid,
          CASE WHEN o_orderpriority = '5-LOW' THEN '1990-01-01'
            WHEN o_orderpriority <> '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') END AS pubmed_date,
          CASE WHEN o_orderkey % 2 = 0 THEN '2002-01-01' ELSE '2002-01-02' END AS landed_on
        FROM orders""",
    "publish_counts": """
        SELECT 0 AS run, count(*) AS hit_count, count(*) AS row_count, 0::BIGINT AS rejected_count
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL
        SELECT 1, count(*), least(100, count(*)), 0 FROM orders""",
    "merge_two_writers": "SELECT event_id, user_id, event_type, value FROM events",
    "quarantine_pipeline": """
        SELECT CASE doc_id % 10 WHEN 1 THEN 'record' WHEN 2 THEN 'record' WHEN 3 THEN 'pmid'
          ELSE 'sound' END AS problem, count(*) AS records
        FROM documents GROUP BY 1""",
    "failure_gate": """
        SELECT load, count(*) AS staged, count(*) FILTER (o_orderkey % share = 0) AS failed,
          CASE WHEN count(*) FILTER (o_orderkey % share = 0) > 0.05 * count(*) THEN 0
            ELSE count(*) FILTER (o_orderkey % share <> 0) END AS loaded
        FROM orders, (VALUES ('few', 100), ('many', 3)) AS loads(load, share) GROUP BY load""",
    "ingest_increments": """
        SELECT doc_id AS pmid, 2::BIGINT AS landed,
          CASE WHEN doc_id % 3 = 2 THEN '2002-01-02' ELSE '2002-01-01' END AS first_day
        FROM documents WHERE doc_id % 10 > 3""",
    "country_aliases": f"""
        SELECT s_suppkey AS l_suppkey,
          {_list(f"['{name}']" if "'" not in name else f'["{name}"]' for name in ALIASED_NAMES)}[s_nationkey + 1]
            AS countries
        FROM supplier""",
    "main_layout": f"WITH {FULL_RUN} SELECT {', '.join(schemas.MAIN_TYPES)} FROM flagged",
    "flagship": f"""
        WITH {FULL_RUN}
        SELECT pmid, doi, pubmed_date, include, mature, {LABEL_SUM} AS label_count,
          affil_countries, affil_first_country, affil_last_country, affil_fill_country,
          countries_lc, lmic_author_flag, lmic_author_lower_flag, lmic_china_flag
        FROM flagged
        WHERE pubmed_date > '{catalog.LOADED_UNTIL}' AND pubmed_date <= '{catalog.TODAY}'
          AND ({_alternation(SEARCH_TEXT, ALL_PHRASES)} OR {BOTH_WORDS}
            OR contains(mesh_terms, '''Standard'''))""",
}
