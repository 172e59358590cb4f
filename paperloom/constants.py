"""Fixed values. Labels, term lists and mappings that results depend on."""

# The 56 characteristics, in the order a multi-label model emits them.
CHARACTERISTICS = [
    "algo_neural_net", "algo_support_vector", "algo_regression", "algo_decision_tree",
    "feat_xr", "feat_ct", "feat_mri", "feat_eeg", "feat_ecg", "feat_emg", "feat_us",
    "feat_echo", "feat_histo", "feat_oct", "feat_mamm", "feat_endoscop", "feat_gene",
    "feat_bio", "feat_nlp", "feat_ehr", "subspec_icu", "subspec_ed", "spec_paeds",
    "spec_id", "subspec_sepsis", "subspec_cov19", "subspec_dermca", "spec_onc",
    "subspec_lungca", "subspec_brainca", "subspec_gica", "subspec_hepca",
    "subspec_prosca", "subspec_gynonc", "subspec_haemonc", "subspec_breastca",
    "subspec_urology", "spec_psych", "spec_msk", "spec_gi", "spec_hep", "spec_resp",
    "subspec_pneum", "spec_neuro", "subspec_epilep", "subspec_cva", "subspec_alzh",
    "spec_cvs", "subspec_ihd", "subspec_hf", "subspec_arrhyt", "spec_dm",
    "subspec_retina", "spec_haem", "spec_obs", "spec_renal",
]

# The main table's bibliographic, label and country columns, in order.
BIBLIOGRAPHIC = [
    "pmid", "doi", "title", "abstract", "article_date", "pubmed_date", "year",
    "article_type", "lang", "journal", "journal_short", "journal_country", "authors",
    "author_affils", "keywords", "mesh_terms", "references_pmids",
]
COUNTRY_COLUMNS = [
    "affil_countries", "affil_countries_unique", "affil_first_country",
    "affil_last_country", "affil_fill_country", "countries_lc", "lmic_author_flag",
    "lmic_author_lower_flag", "lmic_china_flag",
]
MAIN_COLUMNS = [*BIBLIOGRAPHIC, "include", "mature", *COUNTRY_COLUMNS, *CHARACTERISTICS]

# Search phrases, words that must all occur, and the subject heading.
SEARCH_PHRASES = [
    "artificial intelligence", "deep learning", "machine learning", "neural net",
    "transfer learning", "supervised learning",
]
SEARCH_ALL_WORDS = [["unsupervised", "learning"]]
SEARCH_HEADINGS = ["artificial intelligence"]

# Most ids one run takes, and rows per scoring batch.
MAX_HITS = 5000
SCORING_BATCH = 100

# Subject-term prefixes that mark an animal study.
ANIMAL_PREFIXES = [
    "Mice", "Rat", "Dog", "Monkey", "Pig", "Cat", "Cow", "Horse", "Bird", "Fish",
]

# Country names rewritten in the first-author country.
COUNTRY_RENAMES = {
    "England": "United Kingdom",
    "Wales": "United Kingdom",
    "Scotland": "United Kingdom",
    "China (Republic : 1949- )": "Taiwan",
}

# Lower-income country terms, then the rest of the wider list. The
# terms are regular expressions and keep their known spellings.
LOWER_INCOME_TERMS = [
    "afghanistan", "burundi", "burkina faso", "central african republic", "congo",
    "eritrea", "ethiopia", "guinea", "gambia", "guinea-bissau", "liberia",
    "madagascar", "mali", "mozambique", "malawi", "niger", "north korea",
    "democratic republic of korea", "rwanda", "sudan", "sierra leone", "somalia",
    "south sudan", "syrian arab republic", "chad", "togo", "uganda", "yemen", "angola",
    "benin", "bangladesh", "belize", "bolivia", "bhutan", "cote d'ivoire",
    "ivory coast", "cameroon", "congo", "comoros", "cabo verde", "djibouti", "algeria",
    "egypt", "micronesia", "ghana", "honduras", "haiti", "indonesia", "india", "iran",
    "kenya", "kyrgyz republic", "cambodia", "kiribati", "lao", "sri lanka", "lesotho",
    "morocco", "myanmar", "mongolia", "mauritania", "nigeria", "nicaragua", "nepal",
    "pakistan", "philippines", "papua new guinea", "west bank and gaza", "palestinbe",
    "senegal", "solomon islands", "el salvador", "sao tome", "eswatini", "tajikistan",
    "timor-leste", "tunisia", "tanzania", "ukraine", "uzbekistan", "vietnam",
    "vanuatu", "samoa", "zambia", "zimbabwe",
]
LOW_MIDDLE_INCOME_TERMS = LOWER_INCOME_TERMS + [
    "albania", "argentina", "armenia", "american samoa", "azerbaijan", "bulgaria",
    "bosnia", "belarus", "brazil", "botswana", "china", "colombia", "costa rica",
    "cuba", "dominica", "dominican republic", "ecuador", "fiji", "gabon", "georgia",
    "equatorial guinea", "grenada", "guatemala", "guyana", "iraq", "jamaica", "jordan",
    "kazakhstan", "lebanon", "libya", "lucia", "moldova", "maldives", "mexico",
    "marshall islands", "north macedonia", "montenegro", "mauritius", "malaysia",
    "namibia", "panama", "peru", "paraguay", "romania", "russian federation", "russia",
    "serbia", "suriname", "thailand", "turkmenistan", "tonga", "turkey", "tuvalu",
    "st. vincent", "grenadines", "kosovo", "south africa", "venezuela",
]

# What the narrower flag matches when run exactly as first deployed.
LOWER_INCOME_TERMS_COMPAT = ["iran", "venezuela"]
CHINA_TERMS = ["china"]
