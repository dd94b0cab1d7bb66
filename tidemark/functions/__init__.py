"""Column expressions shared by the operators; all run JVM-side."""

from tidemark.functions.images import (
    bucket_of, fingerprint, json_of, key_json, null_safe, row_hash, row_image, same_image,
)
from tidemark.functions.rules import (
    any_of, bool_true, sql_rule, text_missing, text_present, text_to_number,
)
from tidemark.functions.stamps import (
    latest_of, minutes_between, ntz, parse_stamp, sortable_text,
)

__all__ = [
    "any_of", "bool_true", "bucket_of", "fingerprint", "json_of", "key_json",
    "latest_of", "minutes_between", "ntz", "null_safe", "parse_stamp", "row_hash", "row_image",
    "same_image", "sortable_text", "sql_rule", "text_missing", "text_present",
    "text_to_number",
]
