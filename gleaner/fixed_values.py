"""Strings and numbers that must equal the original tool's so
that the same inputs give the same results (addresses, name patterns,
labels, field lists, limits and weights).  Stated once, here, in the
original's order; every module imports them from this file.
"""

# --- Fixed values: addresses -------------------------------------------------
LISTING_BASE_URL = "https://gepris.dfg.de"
SEARCH_URL_PREFIX = "https://cordis.europa.eu/search?q="
SEARCH_URL_SUFFIX = "&p=1&num=10&srt=Relevance:decreasing"
PROJECT_BASE_URL = "https://cordis.europa.eu/project/id/"
XML_URL_SUFFIX = "?format=xml"
PROJECT_NAMESPACE = "http://cordis.europa.eu"

# --- Fixed values: names of stored things ------------------------------------
XML_FILE_PREFIX = "cordis_project_"
XML_FILE_SUFFIX = ".xml"
VERSION_SUFFIX = "-cordis-auto"
BATCH_PREFIX = "cordis_batch_"
MANIFEST_SUFFIX = "_metadata"

# --- Fixed values: search results --------------------------------------------
PAGE_SIZE = 10
FALLBACK_TITLE = "Unknown Title"
FALLBACK_RELEVANCE = 0.5
RESULT_SELECTOR_NAMES = [".result", "[data-testid='result-item']", ".search-result",
                         "div[class*='result']", "article", ".project-item"]
SUBPAGE_MARKERS = ["/reporting", "/factsheet"]
DOWNLOAD_ELEMENTS_SHOWN, DOWNLOAD_TEXT_CUT = 5, 50

# --- Fixed values: matching (weights in milli-points) ------------------------
RATIO_WEIGHT, PARTIAL_WEIGHT, TOKEN_SET_WEIGHT = 4, 3, 2     # 0.4, 0.3, 0.2 per point
DESCRIPTION_BONUS, DESCRIPTION_WORD_BONUS = 100, 50          # 0.1, 0.05
ACRONYM_BONUS, EXACT_BONUS = 200, 300                        # 0.2, 0.3
HIGH_CONFIDENCE_MILLI = 900                                  # strictly above 0.9
DISAMBIGUATION_TOP, TITLE_CUT, DESCRIPTION_CUT = 5, 60, 80

# --- Fixed values: manifest defaults ------------------------------------------
MANIFEST_DEFAULT_TITLE = "Unknown"
MANIFEST_DEFAULT_ACRONYM = ""

# --- Fixed values: record pages -----------------------------------------------
TITLE_FIELD = "Projekt"
TEXT_FIELD = "Projektbeschreibung"
APPLICANT_SOURCES = ["Antragsteller", "Antragstellerin", "Antragsteller/in"]
APPLICANT_FIELD = "Antragsteller/in"
INSTITUTION_SOURCES = ["Antragstellende Institution", "Beteiligte Institution"]
INSTITUTION_FIELD = "Institution(en)"

# --- Fixed values: XML records -------------------------------------------------
METADATA_FIELDS = ["id", "acronym", "title", "objective", "startDate", "endDate",
                   "totalCost", "ecMaxContribution", "keywords"]
ESSENTIAL_FIELDS = ["title", "startDate", "totalCost"]
MIN_BYTES = 1000
MAX_BYTES = 10 * 1024 * 1024
