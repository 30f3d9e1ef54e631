"""Top keywords per document by TF-IDF over the whole corpus.

Stands in for the source system's per-posting keyword call to an external
language model: same contract (text -> up to 3 comma-separated terms), but
computed corpus-wide as a Spark job, so the result is *not* what a language
model would return.

Plan shape (every document, every token, no sampling):
  texts     cleaned texts meet by document: the one shuffle of all the text
  tf        groupBy(doc, term).count        in place, no (doc, term) row is shuffled for it
  df        groupBy(term).count over tf     partial aggregate absorbs hot terms
  common    terms of 1 in COMMON documents or more, a table that is staged first and then
            broadcast: at most COMMON times the terms of a mean document, but most tf rows
  prune     row_number() <= k per doc among the common terms, in place
  score     what is left of those is scored already; a rarer term, of which no row is pruned,
            is counted by a window over its rows, fewer than N / COMMON
  top k     row_number() <= k per doc       partial WindowGroupLimit before shuffle
  keywords  ordered join of <= k terms per doc; documents without a term keep
            their null row to the end
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import run_dir

# Token rule: lower case, split on anything that is not a letter, a digit, '+'
# or '#' (c++, c#), and keep tokens that have a letter or a digit.
TOKEN_SPLIT = r"[^\p{L}\p{N}+#]+"
TOKEN = r"[\p{L}\p{N}]"
SCORE_DIGITS = 9
COMMON = 2000


def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_length: int = 1) -> DataFrame:
    """(doc, term, n): term counts per document over the whole text.

    Every document keeps a row: what is no term counts under a null one.
    Texts meet by document before they are split, as they are much smaller than
    their terms; the number of partitions is the session's, so that adaptive
    execution does not join them to few that hold more terms than fit memory.
    Tokens are tested after the explode, as plain rows inside codegen.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    token = F.col("token")
    kept = F.when((F.length(token) >= min_length) & token.rlike(TOKEN), token)
    spaced = F.regexp_replace(F.lower(F.col(text_col)), TOKEN_SPLIT, " ")
    return (docs.select(F.col(id_col).alias("doc"), spaced.alias("text")).repartition(parts, "doc")
            .select("doc", F.explode_outer(F.split("text", " ")).alias("token"))
            .select("doc", kept.alias("term"))
            .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("n")))


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_length: int = 1) -> DataFrame:
    """(doc, term, score) with score = n * ln(N / df); a null term has a null score.

    n is the raw count of the term in the document (the document's length is
    a constant factor within a document, so it cannot change a ranking).
    """
    n_docs, tf = _count(docs), doc_terms(docs, id_col, text_col, min_length)
    return tf.join(_df(tf), "term", "left").select("doc", "term", _score(n_docs).alias("score"))


def _count(docs: DataFrame) -> Column:
    return docs.agg(F.count(F.lit(1)).cast("double")).scalar()


def _df(tf: DataFrame) -> DataFrame:
    """(term, df): documents where the term occurs."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _score(n_docs: Column) -> Column:
    return F.col("n") * F.log(n_docs / F.col("df"))


def top_keywords(docs: DataFrame, k: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", sep: str = ", ", min_length: int = 1) -> DataFrame:
    """One row per document: its k best terms joined with `sep` ('' if none).

    Ranked on the score rounded to 9 digits, descending, then the term.
    """
    spark = docs.sparkSession
    n_docs, tf = _count(docs), doc_terms(docs, id_col, text_col, min_length)
    staged = f"{run_dir(spark, 'keywords')}/common"
    _df(tf).filter(F.col("term").isNotNull() & (F.col("df") * COMMON >= n_docs)).write.parquet(staged)
    common = F.broadcast(spark.read.schema("term string, df long").parquet(staged))
    best = (F.round("score", SCORE_DIGITS).desc_nulls_last(), F.col("term").asc())
    # Of a document's common terms only the k best can be among its k best.
    rare = F.col("term").isNotNull() & F.col("df").isNull()
    held = (tf.join(common, "term", "left").withColumns({"score": _score(n_docs), "rare": rare})
            .withColumn("rk", F.row_number().over(Window.partitionBy("doc", "rare").orderBy(*best)))
            .filter(F.col("rare") | (F.col("rk") <= k)).drop("score", "rk"))
    # Rows of a common term need no count: they are dealt by document.
    alike = Window.partitionBy(F.when(F.col("rare"), F.col("term")), F.when(~F.col("rare"), F.col("doc")))
    counted = held.withColumn("df", F.when(F.col("rare"), F.count(F.lit(1)).over(alike)).otherwise(F.col("df")))
    w = Window.partitionBy("doc").orderBy(*best)
    top = (counted.select("doc", "term", _score(n_docs).alias("score"))
           .withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k))
    picked = F.filter(F.array_sort(F.collect_list(F.struct("rk", "term"))),
                      lambda s: s["term"].isNotNull())
    return (top.groupBy("doc")
            .agg(F.array_join(F.transform(picked, lambda s: s["term"]), sep).alias("keywords"))
            .withColumnRenamed("doc", id_col))
