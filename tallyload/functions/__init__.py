"""Scalar column functions (B4 B5 B6 B7 and registry type names)."""

from tallyload.functions.naming import (
    dest_table_name,
    family_name,
    file_extension,
    normalize_path,
    period_of,
    split_mode,
)
from tallyload.functions.states import state_code, state_name, state_text
from tallyload.functions.timestamps import content_timestamp

__all__ = [
    "content_timestamp",
    "dest_table_name",
    "family_name",
    "file_extension",
    "normalize_path",
    "period_of",
    "split_mode",
    "state_code",
    "state_name",
    "state_text",
]
