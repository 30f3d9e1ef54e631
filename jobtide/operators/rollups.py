"""Dashboard count rollups (hash aggregate: partial per map task, then final)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as J

# Fixed value: locations holding this phrase are expiry notes, not places.
EXPIRED_LOCATION_PHRASE = "Hết hạn"


def count_by(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per value, most frequent first; ties by value for a stable order."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc_nulls_last(col)))


def location_count(df: DataFrame, col: str = "location") -> DataFrame:
    """Postings per location, dropping expiry notes that landed in the location."""
    return count_by(df.filter(~F.col(col).contains(EXPIRED_LOCATION_PHRASE)), col)


def category_count(df: DataFrame, col: str = "category", clean: bool = True) -> DataFrame:
    """Postings per clean category (the dashboard's pie chart)."""
    if clean:
        df = df.withColumn(col, J.category_clean(col))
    return count_by(df, col)


def category_salary(df: DataFrame, million_only_if_marked: bool = False) -> DataFrame:
    """Postings per clean category with the average parsed salary and its unit."""
    parsed = J.with_salary_columns(df.select("category", "salary"), "salary",
                                   million_only_if_marked, ("low", "high", "avg", "unit"))
    return (parsed.select(J.category_clean("category").alias("category"), "avg", "unit")
            .groupBy("category", "unit")
            .agg(F.count(F.lit(1)).alias("postings"),
                 F.count("avg").alias("with_salary"),
                 F.avg("avg").alias("avg_salary")))
