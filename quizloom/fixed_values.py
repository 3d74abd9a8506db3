"""Values that results depend on, kept in one place."""

# Subject areas accepted in tagged raw text.
SUBJECT_AREAS = [
    "ETHICS",
    "CONSTITUTIONAL",
    "CIVIL",
    "CIVIL-PROCEDURE",
    "ADMINISTRATIVE",
    "LABOUR",
    "CRIMINAL",
    "CRIMINAL-PROCEDURE",
    "LABOUR-PROCEDURE",
    "TAXES",
    "BUSINESS",
    "HUMAN-RIGHTS",
    "CHILDREN",
    "CONSUMER",
    "INTERNATIONAL",
    "ENVIRONMENTAL",
    "PHILOSOPHY",
]

# Known misspelling in raw files, and the label for "not identified".
AREA_FIXES = {"PHILOSHOPY": "PHILOSOPHY"}
UNKNOWN_AREA = "NI"

# USD per million tokens as (input, output), by model class.
TOKEN_PRICES = {"pro": (2.00, 12.00), "flash": (0.50, 3.00)}

# File naming of the paired documents and of the two exam series.
EXAM_SUFFIX = "-prova"
KEY_SUFFIX = "-gabarito"
NUMBERED_SERIES = "oab"
DATED_SERIES = "enam"

# Fixed value: a downloaded document below this size is an error page.
MIN_DOCUMENT_BYTES = 5000

# Document kinds, in reporting order, and the label prefix of key pages.
EXAM_KIND = "prova"
KEY_KIND = "gabarito"
KEY_PAGE_PREFIX = "gab-"

# Words that tell exam and answer-key links apart (lower case).
EXAM_LINK_TEXT = "tipo 1"
EXAM_LINK_HREF = "tipo_1"
KEY_LINK_ALL = ["gabarito", "preliminar"]
KEY_LINK_NONE = ["2ª fase", "prático"]
FALLBACK_KEY_ALL = ["gabarito"]
FALLBACK_KEY_NONE = ["2ª fase", "prático", "justificado", "padrão"]
