"""Sources and sinks: the given tables, the postings view, connectors."""

from .connectors import (PRODUCER_OPTIONS, jdbc_append, jdbc_query, jdbc_table, kafka_publish,
                         kafka_source_options, read, read_stream, write)
from .tables import (FIXTURE_MARK, JOBS_SQL, TABLES, jobs, jobs_as_lake, jobs_as_records,
                     load_table, table_path)

__all__ = ["PRODUCER_OPTIONS", "jdbc_append", "jdbc_query", "jdbc_table", "kafka_publish", "kafka_source_options", "read",
           "read_stream", "write", "FIXTURE_MARK", "JOBS_SQL", "TABLES", "jobs", "jobs_as_lake",
           "jobs_as_records", "load_table", "table_path"]
