"""Fixed schemas at each stage of the pipeline (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# One JSON object per message; `createdAt` is the producer's date-as-array
# form [y, M, d, h, m, s, nanos] where trailing zero seconds/nanos may be
# missing.
WIRE_SCHEMA = T.StructType([
    T.StructField("jobId", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("salary", T.StringType()),
    T.StructField("skill", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("expiredAt", T.StringType()),
    T.StructField("postedAt", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("createdAt", T.ArrayType(T.IntegerType())),
])

# Lake rows after ingest, in the column order the ingest produces.
LAKE_COLUMNS = ["job_id", "title", "company", "location", "salary", "skill", "category",
                "url", "source", "scraped_at", "expired_at", "posted_at"]

LAKE_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("salary", T.StringType()),
    T.StructField("skill", T.ArrayType(T.StringType())),
    T.StructField("category", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("expired_at", T.TimestampType()),
    T.StructField("posted_at", T.TimestampType()),
])

# Lake primary key: partition key first, then the clustering columns.
LAKE_KEY = ["source", "scraped_at", "job_id"]

# Mart columns in table order; `salary` is the parsed average.
MART_COLUMNS = ["job_id", "title", "company", "location", "salary", "salaryunit", "category",
                "expired_at", "posted_at", "skill", "url", "source", "scraped_at"]

MART_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("salary", T.DoubleType()),
    T.StructField("salaryunit", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("expired_at", T.DateType()),
    T.StructField("posted_at", T.DateType()),
    T.StructField("skill", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
])
