"""Input tables: the given parquet tables and the `jobs` postings view.

`jobs` is built from `orders` with one SQL statement that runs unchanged in
Spark SQL and in DuckDB, so it grows with the scale factor (15,000 rows at
sf0.01) and the oracle queries can start from the same rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as J

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Shared by Spark and the DuckDB oracle (where `orders` is a registered view).
JOBS_SQL = """
SELECT CAST(o_orderkey AS STRING) AS job_id,
 CASE o_orderkey % 4 WHEN 1 THEN concat('K\u1ef9  s\u01b0 ', CAST(o_custkey % 7 AS STRING))
  WHEN 3 THEN concat('Ky\u0303 su\u031b\t', CAST(o_custkey % 7 AS STRING))
  ELSE concat('  Data   Engineer ', CAST(o_custkey % 7 AS STRING)) END AS title,
 concat(CASE o_custkey % 3 WHEN 0 THEN 'R&D "Lab" <' ELSE 'Company ' END, CAST(o_custkey AS STRING)) AS company,
 CASE o_orderkey % 4 WHEN 0 THEN 'Hồ Chí Minh' WHEN 1 THEN 'Hà Nội' WHEN 2 THEN 'Hết hạn trong 3 ngày' ELSE 'Đà Nẵng' END AS location,
 CASE o_orderkey % 12 WHEN 0 THEN '25 Tr - 35 Tr VND' WHEN 1 THEN 'Thương lượng' WHEN 2 THEN '$1,000 - $2,000 /tháng'
  WHEN 3 THEN 'Trên 20 triệu' WHEN 4 THEN 'Dưới 10 triệu' WHEN 5 THEN '15 Tr VND' WHEN 6 THEN 'Cạnh tranh'
  WHEN 7 THEN NULL WHEN 8 THEN 'Tới 1.5 triệu'
  WHEN 9 THEN '20,000,000 VND' WHEN 10 THEN '' ELSE 'hoa hồng' END AS salary,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Python,  SQL, Spark' END AS skill,
 CASE o_orderkey % 5 WHEN 0 THEN '> IT - Phần mềm / Data' WHEN 1 THEN 'Marketing, Sales' WHEN 2 THEN ' - ' WHEN 3 THEN NULL
  ELSE 'Kế toán|Kiểm toán' END AS category,
 CASE o_orderkey % 7 WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 0 THEN 'Hết hạn trong 10 ngày' WHEN 1 THEN 'Hết hạn trong 1 tháng' WHEN 2 THEN 'Hết hạn trong 2 tuần'
  ELSE 'Không rõ' END AS expire_text,
 o_orderdate AS posted_at,
 concat(CASE o_orderkey % 5 WHEN 2 THEN 'HTTPS://Jobs.Example/' ELSE 'https://jobs.example/' END, CAST(o_orderkey % 5000 AS STRING)) AS url,
 CASE o_orderkey % 3 WHEN 0 THEN 'VietnamWorks' ELSE 'Careerviet' END AS source,
 o_orderdate + INTERVAL '1' SECOND * (CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 60 * (o_orderkey % 1440)
  ELSE o_orderkey % 86400 END) AS scraped_at
FROM orders
"""

# Incremental split used by the fixtures: rows scraped after this are new.
FIXTURE_MARK = "1999-01-01 00:00:00"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its splits (`spark.sql.files.maxPartitionBytes`) are the parallelism."""
    return spark.read.parquet(table_path(sf_dir, name))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings view over `orders` (see JOBS_SQL)."""
    return spark.sql(JOBS_SQL.replace("FROM orders", "FROM {orders}"),
                     orders=load_table(spark, sf_dir, "orders"))


def jobs_as_lake(jobs_df: DataFrame) -> DataFrame:
    """Postings in lake shape: skills as an array, expiry resolved, timestamps.

    This is what the ingest stores for each collected posting: the collector
    resolves the relative expiry text against the posted date.
    """
    expired = J.relative_expiry(F.col("posted_at"), F.col("expire_text"))
    return jobs_df.select(
        "job_id", "title", "company", "location", "salary",
        J.skill_split("skill").alias("skill"),
        "category", "url", "source",
        F.col("scraped_at").cast("timestamp").alias("scraped_at"),
        expired.cast("timestamp").alias("expired_at"),
        F.col("posted_at").cast("timestamp").alias("posted_at"),
    )


def jobs_as_records(jobs_df: DataFrame, *keep: str) -> DataFrame:
    """Postings as the collector emits them (wire record fields, text dates), and the columns `keep`."""
    expired = J.relative_expiry(F.col("posted_at"), F.col("expire_text"))
    return jobs_df.select(
        F.col("job_id").alias("jobId"), "title", "company", "location", "salary", "skill",
        "category",
        J.format_wire_date(expired).alias("expiredAt"),
        J.format_wire_date(F.col("posted_at")).alias("postedAt"),
        "url", "source",
        J.timestamp_to_parts(F.col("scraped_at").cast("timestamp")).alias("createdAt"),
        *keep,
    )
