"""Schemas, column names and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the applicant files, in file order, with their internal names.
APPLICANT_COLUMNS = {
    "Age": "age",
    "Sex": "sex",
    "Job": "job",
    "Housing": "housing",
    "Saving accounts": "saving_accounts",
    "Checking account": "checking_account",
    "Credit amount": "credit_amount",
    "Duration": "duration",
    "Purpose": "purpose",
}

APPLICANT = T.StructType(
    [
        T.StructField("age", T.LongType()),
        T.StructField("sex", T.StringType()),
        T.StructField("job", T.IntegerType()),
        T.StructField("housing", T.StringType()),
        T.StructField("saving_accounts", T.StringType()),
        T.StructField("checking_account", T.StringType()),
        T.StructField("credit_amount", T.LongType()),
        T.StructField("duration", T.LongType()),
        T.StructField("purpose", T.StringType()),
    ]
)
DESCRIBED = T.StructType(APPLICANT.fields + [T.StructField("description", T.StringType())])
LABELLED = T.StructType(DESCRIBED.fields + [T.StructField("target", T.StringType())])

# Labels, the error sentinel and the fill word.
GOOD = "good risk"
BAD = "bad risk"
ERROR = "ERROR"
UNKNOWN = "unknown"
LABELS = (GOOD, BAD)
LABEL_TO_CLASS = {GOOD: 1, BAD: 0}
FILL_UNKNOWN = {"saving_accounts": UNKNOWN, "checking_account": UNKNOWN}

# Texts read as null by the CSV convention the data was written with.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Quartile labels, lowest bin first.
BIN_LABELS = {
    "credit_amount": ("low", "mid-low", "mid-high", "high"),
    "age": ("young", "mid-young", "mid-old", "old"),
    "duration": ("short", "mid-short", "mid-long", "long"),
}
BIN_COLUMNS = {"credit_amount": "credit_bin", "age": "age_bin", "duration": "duration_bin"}
DISPLAY_BIN_LABELS = ("Low", "Mid-Low", "Mid-High", "High")
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)

# Order of the encoded feature blocks.
FEATURES = (
    "sex", "job", "housing", "saving_accounts", "checking_account", "purpose", "credit_bin", "age_bin",
    "duration_bin",
)
