"""String predicates and projections used across the sweep."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftsweep.schema import BLANK_VALUES, NA_TOKENS, NAME_STRIP_SUFFIXES, PY_WHITESPACE_CLASS


def na_to_null(c: Column) -> Column:
    """Reader missing-value tokens become NULL on an exact, untrimmed match."""
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def non_blank(c: Column) -> Column:
    """Not NULL, not '' and not exactly one space."""
    return c.isNotNull() & ~c.isin(BLANK_VALUES)


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(c, f"^{ws}+|{ws}+$", "")


def py_split(c: Column) -> Column:
    """Python ``str.split()`` with no separator: runs of whitespace, no empty tokens."""
    text = py_strip(c)  # only an empty text has an empty token then
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, f"{PY_WHITESPACE_CLASS}+"))


def clean_header(c: Column) -> Column:
    """Optional header cleaner (off by default): keep ASCII letters, lower-case, trim."""
    return F.trim(F.lower(F.regexp_replace(c, "[^a-zA-Z]", "")))


def dataset_name(file: Column, sheet: Column) -> Column:
    """File name with every .xlsx/.xls/.csv removed, plus ``_sheet`` for workbook sheets."""
    pattern = "|".join(s.replace(".", "\\.") for s in NAME_STRIP_SUFFIXES)
    stem = F.regexp_replace(file, pattern, "")
    return F.when(sheet.isNull(), stem).otherwise(F.concat(stem, F.lit("_"), sheet))


def extension(file: Column) -> Column:
    """Lower-cased extension including the dot ('' when there is none)."""
    return F.lower(F.regexp_extract(file, r"(\.[^./]*)$", 1))


def basename(path: Column) -> Column:
    """Last path component."""
    return F.element_at(F.split(path, "/"), -1)
