"""Fixed values.

Everything in this file has to equal the published rules of the quality gate
for results to match: patterns, word lists, thresholds, labels and weights.
The rest of the package only refers to these names.
"""

# Whitespace as Unicode defines it. Java's and RE2's ``\s`` cover ASCII only,
# so the characters are spelled out and used for trimming and in the patterns.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters inside a regular-expression class; and the ASCII ones.
WHITESPACE_CLASS = (
    r"\s\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028-\u2029\u202f\u205f\u3000"
)
ASCII_WHITESPACE_CLASS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f "

# Value patterns (WS stands for the whitespace class above).
EMAIL = r"^[^@WS]+@[^@WS]+\.[^@WS]+$"
PHONE_LOOSE = r"^(0|\+44)\d{9,10}$"      # used when profiling
PHONE_STRICT = r"^(0|\+44)\d{10}$"       # used when cleaning and validating
POSTCODE = r"(?i)^[A-Z]{1,2}\d{1,2}[A-Z]?[WS]*\d[A-Z]{2}$"
NUMERIC_LIKE = r"^[£$€]?[WS]*-?[\d,]+(\.\d+)?[WS]*%?$"
DECORATED = r"[£$€%,]"
# Possessive: the plain form recurses once per word in java.util.regex and
# overflows the stack on long texts; letters and spaces never overlap, so both
# forms accept the same values.
PERSON_NAME = r"^[A-Za-z]++(?:[WS][A-Za-z]++)++$"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Date shapes, by the label reports show.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"                 # YYYY-MM-DD
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"           # DD/MM/YYYY
MONTH_YEAR = r"^[A-Za-z]{3,}[WS]+\d{4}$"          # Mon YYYY
MONTH_YEAR_STRICT = r"^[A-Za-z]{3,9} \d{4}$"      # the shape cleaning parses
DATE_SHAPES = ("DD/MM/YYYY", "Mon YYYY", "YYYY-MM-DD")

# Characters removed before a text is read as a number.
CURRENCY = "£$€,"
CURRENCY_AND_PERCENT = "£$€,%"

# Spellings.
BOOLEAN_SPELLINGS = ("true", "false", "yes", "no", "y", "n", "0", "1")
MAX_BOOLEAN_SPELLINGS = 3
YES_SPELLINGS = ("yes", "y", "1", "true")
NO_SPELLINGS = ("no", "n", "0", "false")
YES_LABEL = "Yes"
NO_LABEL = "No"
INVALID_PHONE_LABEL = "INVALID_PHONE"

# Tokens a CSV reader takes for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Name hints, in order of precedence.
NAME_HINTS = {
    "email": ("email", "e-mail", "mail"),
    "phone": ("phone", "mobile", "tel", "contact_number", "contact_no"),
    "postcode": ("postcode", "post_code", "postal", "zip"),
    "date": ("date", "_at", "_on", "timestamp", "dob", "birth"),
}
PII_TYPES = ("email", "phone", "postcode", "person_name", "identifier")

# Thresholds.
MATCH_THRESHOLD = 0.8
IDENTIFIER_UNIQUENESS = 0.9
HIGH_CARDINALITY = 0.9
HIGH_MISSING_PCT = 50.0
CATEGORICAL_MIN = 20
CATEGORICAL_SHARE = 0.05
TOP_VALUES = 5
SAMPLE_VALUES = 500
MAX_EXAMPLES = 5
NEGATIVE_MINORITY = 0.05
WHISKER = 1.5

# Score weights.
BASE_WEIGHTS = (0.7, 0.3)            # completeness, uniqueness
PROFILE_WEIGHTS = (0.5, 0.2, 0.3)    # completeness, uniqueness, validity
HEALTH_WEIGHTS = (0.7, 0.3)          # rule pass rate, anomaly-free rate

# Anomaly detection.
CONTAMINATION = 0.05
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_SEED = 42
