"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from driftsweep.functions.dates import normalise_date, parse_date
from driftsweep.functions.similarity import indel_ratio, lcs_length, passes_threshold
from driftsweep.functions.text import (
    basename,
    clean_header,
    dataset_name,
    extension,
    na_to_null,
    non_blank,
    py_split,
    py_strip,
)

__all__ = [
    "basename", "clean_header", "dataset_name", "extension", "indel_ratio", "lcs_length",
    "na_to_null", "non_blank", "normalise_date", "parse_date", "passes_threshold", "py_split",
    "py_strip",
]
