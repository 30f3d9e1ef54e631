"""Structured Streaming jobs: ingest to the lake, dedup with expiry."""

from .dedup import accept_batch, accepted_keys, expire_sets, stream_dedup
from .ingest import lake_batch_writer, parsed_stream, stream_ingest
from .progress import ProgressTable, last_reports, read_progress

__all__ = ["accept_batch", "accepted_keys", "expire_sets", "stream_dedup", "lake_batch_writer", "parsed_stream", "stream_ingest",
           "ProgressTable", "last_reports", "read_progress"]
