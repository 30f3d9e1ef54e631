"""Column-level building blocks (built-in Spark expressions only; NFC is the one
pandas UDF). The salary parser works on a DataFrame: it stages its intermediates
as columns so every regex runs once per row."""

from .dates import (collected_now, first_int, format_wire_date, mart_date, mdy_text, mdy_text_from_iso,
                    parse_wire_date, relative_expiry, timestamp_from_parts, timestamp_text,
                    timestamp_to_parts)
from .html import (extract_all_text, extract_field, label_value, labelled_item, nth_item, url_host,
                   url_page)
from .salary import normalize_text, with_salary_columns
from .text import (category_clean, collapse_ws, contains_any, dedup_key, java_trim, nfc,
                   random_id, skill_join, skill_split, stable_id)

__all__ = [
    "category_clean", "collapse_ws", "contains_any", "dedup_key", "java_trim", "nfc",
    "random_id", "skill_join", "skill_split", "stable_id", "normalize_text", "with_salary_columns",
    "collected_now", "first_int", "format_wire_date", "mart_date", "mdy_text", "mdy_text_from_iso",
    "parse_wire_date", "relative_expiry", "timestamp_from_parts", "timestamp_text",
    "timestamp_to_parts",
    "extract_all_text", "extract_field", "label_value", "labelled_item", "nth_item", "url_host", "url_page",
]
