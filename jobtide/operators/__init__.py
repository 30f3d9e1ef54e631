"""DataFrame -> DataFrame operators of the pipeline."""

from .dedup import dedup_batch, drop_seen, merge_sources, seen_keys, with_dedup_key
from .incremental import (DEFAULT_MARK, answered_by_footers, high_water_mark, incremental_load, mark_value,
                          marked_mart_sink, parquet_mart_sink, run_incremental, stored_mark, stored_max)
from .ingest import (all_records, decode_value, ingest_counts, parse_json, parse_records,
                     split_quarantine, to_lake_rows, with_row_count)
from .keywords import doc_terms, tfidf, top_keywords
from .lake import (PARTITION_COLUMNS, after, file_system, lake_current, lake_layout, latest_batch,
                   read_current, read_lake, read_or_empty, run_of, snapshot_current,
                   with_scraped_month, write_lake_batch)
from .mart import NEGOTIABLE_PHRASES, mart_clean, negotiable_filter, with_salary
from .merge import merge_batch, merge_lake, merged_state, read_merged, upserted
from .pages import cap_listing, cap_per_group, page_fields, page_postings, with_listing_position
from .publish import publish_envelope
from .rollups import category_count, category_salary, count_by, location_count
from .seen import probed, read_seen, store_seen, unseen

__all__ = [
    "dedup_batch", "drop_seen", "merge_sources", "seen_keys", "with_dedup_key",
    "DEFAULT_MARK", "high_water_mark", "incremental_load", "mark_value", "parquet_mart_sink",
    "answered_by_footers", "marked_mart_sink", "run_incremental", "stored_mark", "stored_max",
    "all_records", "decode_value", "ingest_counts", "parse_json", "parse_records",
    "split_quarantine", "to_lake_rows",
    "with_row_count", "doc_terms", "tfidf", "top_keywords",
    "PARTITION_COLUMNS", "after", "file_system", "lake_current", "lake_layout", "latest_batch", "read_current",
    "read_lake", "read_or_empty", "run_of", "snapshot_current", "with_scraped_month",
    "write_lake_batch",
    "probed", "read_seen", "store_seen", "unseen",
    "merge_batch", "merge_lake", "merged_state", "read_merged", "upserted",
    "NEGOTIABLE_PHRASES", "mart_clean", "negotiable_filter", "with_salary",
    "cap_listing", "cap_per_group", "page_fields", "page_postings", "with_listing_position",
    "publish_envelope", "category_count", "category_salary", "count_by", "location_count",
]
