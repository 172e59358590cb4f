"""Name lists for country and place recognition.

Country names map spelling -> canonical name and are bounded by nature. Cities and
places are tables of any size: ``city``/``place`` with the ``address`` they resolve to.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Other spellings of countries, the nations of the United Kingdom, and the names
# that the income lists use for a country.
ALIASES = {
    "USA": "United States", "U.S.A.": "United States", "United States of America": "United States",
    "UK": "United Kingdom", "U.K.": "United Kingdom", "Great Britain": "United Kingdom",
    "England": "England", "Scotland": "Scotland", "Wales": "Wales",
    "Northern Ireland": "Northern Ireland", "Republic of Ireland": "Ireland",
    "P.R. China": "China", "PR China": "China", "P. R. China": "China",
    "People's Republic of China": "China", "Peoples Republic of China": "China",
    "Hong Kong": "Hong Kong", "Hong Kong SAR China": "Hong Kong",
    "Macau": "Macao", "Macao": "Macao", "Macao SAR China": "Macao",
    "Republic of China": "Taiwan", "Korea": "South Korea", "Republic of Korea": "South Korea",
    "Democratic People's Republic of Korea": "Democratic Republic of Korea",
    "DPR Korea": "Democratic Republic of Korea",
    "Viet Nam": "Vietnam", "Lao PDR": "Laos", "Lao People's Democratic Republic": "Laos",
    "Burma": "Myanmar", "Myanmar": "Myanmar", "Myanmar (Burma)": "Myanmar",
    "Brunei Darussalam": "Brunei", "Czech Republic": "Czechia", "The Netherlands": "Netherlands",
    "Holland": "Netherlands", "Macedonia": "North Macedonia", "Bosnia": "Bosnia & Herzegovina",
    "Bosnia and Herzegovina": "Bosnia & Herzegovina", "Republic of Moldova": "Moldova",
    "Russian Federation": "Russian Federation", "Republic of Belarus": "Belarus",
    "Türkiye": "Turkey", "Turkiye": "Turkey", "Turkey": "Turkey", "Kosovo": "Kosovo",
    "Kyrgyzstan": "Kyrgyz Republic", "Kyrgyz Republic": "Kyrgyz Republic",
    "Syria": "Syrian Arab Republic", "Syrian Arab Republic": "Syrian Arab Republic",
    "Islamic Republic of Iran": "Iran", "I.R. Iran": "Iran", "UAE": "United Arab Emirates",
    "Kingdom of Saudi Arabia": "Saudi Arabia", "Palestine": "West Bank and Gaza",
    "Palestinian Territories": "West Bank and Gaza", "Gaza": "West Bank and Gaza",
    "West Bank": "West Bank and Gaza", "West Bank and Gaza": "West Bank and Gaza",
    "Côte d’Ivoire": "Cote d'Ivoire", "Côte d'Ivoire": "Cote d'Ivoire",
    "Cote d'Ivoire": "Cote d'Ivoire", "Ivory Coast": "Ivory Coast",
    "Cape Verde": "Cabo Verde", "Cabo Verde": "Cabo Verde",
    "São Tomé & Príncipe": "Sao Tome & Principe", "Sao Tome and Principe": "Sao Tome & Principe",
    "Swaziland": "Eswatini", "The Gambia": "Gambia", "United Republic of Tanzania": "Tanzania",
    "Congo - Kinshasa": "Democratic Republic of the Congo", "DR Congo": "Democratic Republic of the Congo",
    "Democratic Republic of the Congo": "Democratic Republic of the Congo",
    "Democratic Republic of Congo": "Democratic Republic of the Congo",
    "Congo - Brazzaville": "Republic of the Congo", "Republic of the Congo": "Republic of the Congo",
    "Congo": "Republic of the Congo", "Bolivarian Republic of Venezuela": "Venezuela",
    "Plurinational State of Bolivia": "Bolivia", "Brasil": "Brazil", "México": "Mexico",
    "Saint Lucia": "St. Lucia", "Saint Vincent and the Grenadines": "St. Vincent & Grenadines",
    "Trinidad and Tobago": "Trinidad & Tobago", "Antigua and Barbuda": "Antigua & Barbuda",
    "East Timor": "Timor-Leste", "Federated States of Micronesia": "Micronesia",
}


def name_table(table: DataFrame, name: str, canonical: str | None = None) -> dict[str, str]:
    """A short name table, such as that of the world's countries, as a dictionary.

    The names become one pattern that travels with every task. For a list that grows with the
    data use a city table, which is joined.
    """
    pairs = table.select(F.col(name), F.col(canonical or name)).where(F.col(name).isNotNull())
    return dict(map(tuple, pairs.distinct().collect()))


def country_spellings(
    spark: SparkSession, aliases: Mapping[str, str] = ALIASES
) -> dict[str, str]:
    """Spelling -> name for all ISO countries, in the JVM's English names, and their aliases."""
    locale = spark.sparkContext._jvm.java.util.Locale
    names = {}
    for code in locale.getISOCountries():
        name = locale.forLanguageTag(f"und-{code}").getDisplayCountry(locale.ENGLISH)
        names[name] = name
    return {**names, **aliases}


def best_address(table: DataFrame, key: str, rank: str | None = None) -> DataFrame:
    """One address per key: the lowest rank, then the first in alphabetical order."""
    order = F.struct(*([rank] if rank else []), "address")
    kept = table.where(F.col(key).isNotNull())
    return kept.groupBy(key).agg(F.min(order).getField("address").alias("address"))
