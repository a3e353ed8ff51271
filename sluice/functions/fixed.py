"""Fixed values the control plane must agree on.

FIXED VALUES: these must stay exactly as written for results to match the
behaviour the toolkit re-implements (allowed codes, code maps, name parts).
"""

# FIXED VALUES — allowed business divisions (case-sensitive, trimmed).
BANNERS = ("MDD", "MAK", "MSB")

# FIXED VALUES — allowed data-sensitivity codes (case-insensitive, not trimmed).
SENSITIVITIES = ("se", "ns", "hs")

# FIXED VALUES — allowed load types (compared upper-cased, not trimmed).
LOAD_TYPES = ("INC", "FULL")

# FIXED VALUES — sensitivity code -> service-account suffix; unknown -> "ns".
SENSITIVITY_ACCOUNT_SUFFIX = {"se": "ns", "ns": "ns", "hs": "hs"}
SENSITIVITY_ACCOUNT_DEFAULT = "ns"

# FIXED VALUES — request row constants.
BUCKET_NAME_TYPE = "hash"
SOFT_DELETE_POLICY = "DCA Logic"
COMPANY_CODE_PREFIX = "SA-"

# FIXED VALUES — unit (job) names: "<prefix>-SA<banner>-<LOAD>-<SCHEMA>-<banner>_<table>".
UNIT_PREFIX = "INTLDLDAT"
UNIT_DIVISION_PREFIX = "SA"
UNIT_PARTS = 5

# FIXED VALUES — load-type label: "inc" -> "incremental load", other -> "<type> load".
INC_LABEL = "incremental load"

# FIXED VALUES — default sensitivity / load type when a work item lacks them.
DEFAULT_SENSITIVITY = "ns"
DEFAULT_LOAD_TYPE = "incremental"

# Text read as missing by the control-table reader (in addition to empty text).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
