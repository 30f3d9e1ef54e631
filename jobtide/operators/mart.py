"""Lake rows -> mart rows: clean category, parse salary, reformat dates.

All native expressions (no UDF), so the projection is one whole-stage
codegen span and the filter runs before the derived columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as J
from ..schema import MART_COLUMNS

# Fixed values that must equal the source system's rules (case-sensitive).
NEGOTIABLE_PHRASES = ("Thương lượng", "Cạnh tranh")


def negotiable_filter(df: DataFrame, col: str = "salary",
                      phrases=NEGOTIABLE_PHRASES) -> DataFrame:
    """Drop rows whose salary contains a negotiable phrase (case-sensitive).

    Three-valued logic: a null salary makes the predicate null, so null
    salaries are dropped too.
    """
    return df.filter(~J.contains_any(col, phrases))


def with_salary(df: DataFrame, col: str = "salary", million_only_if_marked: bool = False,
                prefix: str = "") -> DataFrame:
    """Add low/high/avg/unit salary columns from the free-text salary."""
    names = tuple(f"{prefix}{n}" for n in ("low", "high", "avg", "unit"))
    return J.with_salary_columns(df, col, million_only_if_marked, names)


def mart_clean(lake: DataFrame, million_only_if_marked: bool = False) -> DataFrame:
    """Lake rows -> the 13 mart columns in table order."""
    kept = negotiable_filter(lake)
    parsed = J.with_salary_columns(kept, "salary", million_only_if_marked,
                                   ("__low", "__high", "__avg", "__unit"))
    return parsed.select(
        "job_id", "title", "company", "location",
        F.col("__avg").alias("salary"),
        F.col("__unit").alias("salaryunit"),
        J.category_clean("category").alias("category"),
        J.mart_date("expired_at").alias("expired_at"),
        J.mart_date("posted_at").alias("posted_at"),
        J.skill_join("skill").alias("skill"),
        "url", "source",
        J.timestamp_text("scraped_at").alias("scraped_at"),
    ).select(*MART_COLUMNS)
