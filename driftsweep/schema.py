"""Fixed values and table schemas of the sweep.

Everything under the FIXED VALUES banner must equal the values of the sweep this
engine re-implements, because resolution, gating and output layout depend on them.
They are stated once, here, in their natural order; every other module derives from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original sweep exactly)
# ---------------------------------------------------------------------------

# Target column -> header aliases, in the order they are tried.
ALIASES: dict[str, list[str]] = {
    "emailaddress": ["EmailAddress", "emailaddress", "EMAILADDRESS"],
    "mobilenumber": ["MobileNumber", "mobilenumber", "MOBILENUMBER"],
    "firstname": ["FirstName", "firstname", "FIRSTNAME"],
    "middlename": ["MiddleName", "middlename", "MIDDLENAME"],
    "lastname": ["LastName", "lastname", "LASTNAME"],
    "addr1": ["Addr1", "addr1", "ADDR1"],
    "addr2": ["Addr2", "addr2", "ADDR2"],
    "city": ["City", "city", "CITY"],
    "state": ["State", "state", "STATE"],
    "zip": ["Zip", "zip", "ZIP"],
    "optouturl": ["OptOutURL", "optouturl", "OPTOUTURL"],
    "var1": ["Var1", "var1", "VAR1"],
    "var2": ["Var2", "var2", "VAR2"],
    "var3": ["Var3", "var3", "VAR3"],
    "var4": ["Var4", "var4", "VAR4"],
    "cid": ["CID", "cid"],
    "subscriberkey": ["SubscriberKey", "subscriberkey", "SUBSCRIBERKEY"],
    "createddate": ["CreatedDate", "createddate", "CREATEDDATE"],
    "lastmodifieddate": ["LastModifiedDate", "lastmodifieddate", "LASTMODIFIEDDATE"],
    "campaignname": ["CampaignName", "campaignname", "CAMPAIGNNAME"],
    "suppressiontype": ["SuppressionType", "suppressiontype", "SUPPRESSIONTYPE"],
    "campaignrunid": ["CampaignRunID", "campaignrunid", "CAMPAIGNRUNID"],
    "highlowip": ["HighLowIP", "highlowip", "HIGHLOWIP"],
    "sent": ["Sent", "sent", "SENT"],
    "sentdate": ["sentdate", "SENTDATE"],
    "open": ["Open", "open", "OPEN"],
    "opendate": ["open date", "OPEN DATE", "opendate", "OPENDATE"],
    "click": ["click", "CLICK"],
    "clickdate": ["clickdate", "CLICKDATE"],
    "hardbounce": ["Hardbounce", "HARDBOUNCE"],
    "softbounce": ["softbounce", "SOFTBOUNCE"],
    "blockedbounce": ["blockedbounce", "BLOCKEDBOUNCE"],
    "unsub": ["unsub", "UNSUB"],
}

# Header gate: a dataset is kept iff some header contains one of these (case-sensitive).
PARTIAL_NAMES: list[str] = [
    "MobileNumber", "FirstName", "MiddleName", "LastName", "Addr1", "Addr2", "City", "State",
    "Zip", "OptOutURL", "Var1", "Var2", "Var3", "Var4", "CID", "SubscriberKey", "CreatedDate",
    "LastModifiedDate", "CampaignName", "SuppressionType", "CampaignRunID", "HighLowIP", "Sent",
    "sentdate", "Open", "open date", "click", "clickdate", "Hardbounce", "softbounce",
    "blockedbounce", "unsub",
]

# Suffixes removed anywhere in a file name to form the dataset name.
NAME_STRIP_SUFFIXES: list[str] = [".xlsx", ".xls", ".csv"]

# Inbox allow-list and discovery order (workbooks, old workbooks, then CSV).
INBOX_EXTENSIONS: list[str] = [".xlsx", ".xls", ".csv"]

# Silver column order.
SILVER_ORDER: list[str] = [
    "rowid", "emailaddress", "mobilenumber", "firstname", "middlename", "lastname", "addr1",
    "addr2", "city", "state", "zip", "optouturl", "var1", "var2", "var3", "var4", "cid",
    "subscriberkey", "createddate", "lastmodifieddate", "campaignname", "suppressiontype",
    "campaignrunid", "highlowip", "sent", "sentdate", "open", "opendate", "click", "clickdate",
    "hardbounce", "softbounce", "blockedbounce", "unsub", "file_name",
]

# Targets normalised to YYYY-MM-DD ('NaT' when missing), in processing order.
DATE_TARGETS: list[str] = [
    "createddate", "lastmodifieddate", "sentdate", "opendate", "clickdate", "hardbounce",
    "softbounce", "blockedbounce", "unsub",
]

# Gold columns, in order; 'NaT' becomes NULL for the date targets, names are upper-cased.
GOLD_ORDER: list[str] = [
    "cid", "firstname", "middlename", "lastname", "subscriberkey", "createddate",
    "lastmodifieddate", "campaignname", "suppressiontype", "campaignrunid", "highlowip", "sent",
    "sentdate", "open", "opendate", "click", "clickdate", "hardbounce", "softbounce",
    "blockedbounce", "unsub", "sourcefile",
]
GOLD_UPPER: list[str] = ["firstname", "middlename", "lastname"]

# Default missing-value tokens of the tabular readers (exact, untrimmed match).
NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Strict resolver threshold: a score must be strictly above this.
SCORE_THRESHOLD = 80

# Values that count as blank for the non-blank row count (besides NULL).
BLANK_VALUES: list[str] = ["", " "]

# ---------------------------------------------------------------------------
# Engine choices (ours, not the original's)
# ---------------------------------------------------------------------------

# Date forms accepted, tried in order; first that parses wins. The first five are the
# contract of FIXTURES.md §5; the rest are common export forms (workbook datetimes with
# fractional seconds, US dates with a time, ISO with 'T').
DATE_FORMATS: list[str] = [
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "MMM d, yyyy", "yyyyMMdd",
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm",
    "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a",
]
NAT = "NaT"

# Characters Python's str.isspace() accepts, as one Java regex class.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

# Minimum data rows per format for a dataset to be kept (CSV counts data rows only,
# workbooks count the header row too, so they need one data row).
MIN_DATA_ROWS = {"csv": 2, "xlsx": 1, "xls": 1}
MIN_COLUMNS = 2

TARGETS: list[str] = list(ALIASES)


def alias_rows() -> list[tuple[int, str, int, str]]:
    """(target_no, target, alias_no, alias) for every alias, in list order."""
    return [(t_no, t, a_no, a) for t_no, (t, al) in enumerate(ALIASES.items()) for a_no, a in enumerate(al)]


SILVER_SCHEMA = T.StructType(
    [T.StructField("rowid", T.LongType(), False)]
    + [T.StructField(c, T.StringType(), True) for c in SILVER_ORDER[1:-1]]
    + [T.StructField("file_name", T.StringType(), False)]
)

GOLD_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in GOLD_ORDER])

# Bronze: every dataset in one table; values as text, aligned with the dataset's headers.
BRONZE_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType(), True),     # dataset name
    T.StructField("source", T.StringType(), True),        # inbox entry (workbooks: entry!sheet)
    T.StructField("part", T.StringType(), True),          # physical file
    T.StructField("src_row", T.LongType(), True),         # row order inside the part
    T.StructField("cells", T.ArrayType(T.StringType()), True),
])

# Dataset catalogue: one row per dataset.
DATASET_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("file_ordinal", T.IntegerType(), True),
    T.StructField("fmt", T.StringType(), True),
    T.StructField("sheet", T.StringType(), True),
    T.StructField("n_rows", T.LongType(), True),
    T.StructField("headers", T.ArrayType(T.StringType()), True),
])

# Non-blank data cells per (dataset, column position): the resolver's only data input.
COUNTS_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("pos", T.IntegerType(), True),
    T.StructField("n_non_blank", T.LongType(), True),
])
