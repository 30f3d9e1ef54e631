"""jobtide: a Spark-native pipeline for job postings.

Postings arrive as JSON messages, are parsed into a partitioned lake table,
deduplicated, and incrementally cleaned into a reporting mart with count
rollups. Every step is a DataFrame transformation; see README.md.
"""

__all__ = ["functions", "operators", "sources", "streaming", "plans", "session", "schema"]
