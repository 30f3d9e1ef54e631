"""Quality rules, line first: clean the lines, then judge what is left.

Every line with a word is tried by the line rules: punctuation (no letters, or
symbols and doubled marks throughout), navigation (separators between its
words, or a short label without an end mark) and boilerplate (a phrase of
page furniture or licence text in a short line). Lines that fail are removed;
a document that loses more than LOST of its word characters that way, or that
fails a base rule on the whole text, is rejected.

Only functions of DataFrames are used, and no shuffle: all of a text's counts
are array functions of its own row, linear in its words but for one sort of
the word windows of texts that repeat any.

Defined results: a null or blank text has no words and fails the base rule on
length. Repeated rows are judged alike, doc_ids are only carried, and other
columns pass through `cleaned`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

LEAST_WORDS = 50       # words of a document
REPEATED = 50          # percent of words in repeated windows
LOST = 0.4             # share of word characters that failing lines may take
SYMBOL_SHARE = 0.1     # of a line's word characters
SEPARATOR_SHARE = 0.2  # of a line's words
DOUBLED_SHARE = 0.3    # of a line's words
SHORT_LABEL = 4        # words of a label without an end mark
SHORT_LINE = 25        # words of a line that a boilerplate phrase makes up

# Phrases of page furniture and licences, in lower case.
PHRASES = ("all rights reserved|click here|cookie policy|copyright ©|enable javascript|forgot password|"
           "licensed under|log in|lorem ipsum|privacy policy|read more|sign in|sign up|subscribe to|"
           "terms of service|terms of use|use cookies")


def _count(line: Column, pattern: str) -> Column:
    return F.regexp_count(line, F.lit(pattern))


def line_fails(line: Column, n_words: Column, n_chars: Column) -> Column:
    """Whether a line with words is removed."""
    punctuation = (~line.rlike(r"\p{L}")
                   | (_count(line, r"[#*$%&|<>@^~{}\\]") > SYMBOL_SHARE * n_chars)
                   | (_count(line, r"(?:!!|\?\?)+") > DOUBLED_SHARE * n_words))
    navigation = ((_count(line, r"[|»›•·]") > SEPARATOR_SHARE * n_words)
                  | ((n_words <= SHORT_LABEL) & ~line.rlike(r"[.!?:;,…\"'”)\]][\x20\x09-\x0D]*$")))
    boilerplate = (n_words <= SHORT_LINE) & F.lower(line).rlike(PHRASES)
    return punctuation | navigation | boilerplate


def measured(docs: DataFrame) -> DataFrame:
    """All columns of `docs` and `__q`: the counts, the verdict and the cleaned lines of each row."""
    columns = docs.columns
    trimmed = F.btrim(text_of(), F.lit(SPACES))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(F.expr("CAST(array() AS array<string>)"))
    base = docs.select(*columns, words.alias("__words"), F.split(text_of(), "\n", -1).alias("__lines"))
    size = F.size("__words")
    windows = F.when(size >= 3, F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))) \
        .otherwise(F.expr("CAST(array() AS array<bigint>)"))
    wordy = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashed = base.select(
        *columns, size.cast("long").alias("__n"), windows.alias("__windows"), wordy.alias("__wordy"),
        F.length(F.regexp_replace(text_of(), SPACE, "")).cast("long").alias("__chars"),
        (F.length(text_of()) - F.length(F.translate(text_of(), SYMBOLS, ""))).cast("long").alias("__symbols"))
    places = F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.sort_array(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    judged = F.transform("__wordy", lambda x: F.struct(
        x.alias("line"), F.size(F.split(F.btrim(x, F.lit(SPACES)), SPACE)).alias("words"),
        F.length(F.regexp_replace(x, SPACE, "")).cast("long").alias("chars")))
    placed = hashed.select(*columns, "__n", "__chars", "__symbols", "__wordy",
                           places.alias("__places"), judged.alias("__judged"))
    repeated = F.filter("__places", lambda x, k: (x["h"] == F.get("__places", k - 1)["h"])
                        | (x["h"] == F.get("__places", k + 1)["h"]))
    marked = placed.select(*columns, "__n", "__chars", "__symbols", "__wordy",
                           F.array_sort(F.transform(repeated, lambda x: x["i"])).alias("__starts"),
                           F.transform("__judged", lambda x: x.withField(
                               "fails", line_fails(x["line"], x["words"], x["chars"]))).alias("__judged"))
    # Each window covers three words, or those up to the next repeated window.
    covered = F.coalesce(F.aggregate(
        F.transform("__starts", lambda s, k: F.least(F.lit(3), F.coalesce(
            F.get("__starts", k + 1) - s, F.lit(3)))), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    lost = F.aggregate(F.filter("__judged", lambda x: x["fails"]), F.lit(0).cast("long"), lambda a, x: a + x["chars"])
    counted = marked.select(
        *columns, "__n", "__chars", "__symbols", "__judged", covered.alias("__repeated"), lost.alias("__lost"),
        (F.size("__wordy") - F.size(F.array_distinct("__wordy"))).cast("long").alias("__dup"))
    failed = (F.col("__n") < LEAST_WORDS) | (100 * F.col("__repeated") > REPEATED * F.col("__n"))
    return counted.select(*columns, F.struct(
        F.col("__n").alias("n_words"), F.col("__chars").alias("word_chars"), F.col("__symbols").alias("n_symbols"),
        F.col("__dup").alias("n_dup_lines"), F.col("__repeated").alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (F.col("__lost") <= LOST * F.col("__chars"))).alias("kept"),
        F.size(F.filter("__judged", lambda x: x["fails"])).cast("long").alias("n_failed_lines"),
        F.col("__lost").alias("lost_chars"), F.col("__judged").alias("lines")).alias("__q"))


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, all columns, `text` without the failing and the empty lines.

    The verdict goes through a Generate, as a filter pushed below the projections
    would repeat their nested expressions inside the predicate.
    """
    text = F.array_join(F.transform(F.filter("__q.lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")
    judged = measured(docs).select(*docs.columns, F.explode(F.array("__q")).alias("__q"))
    return judged.filter("__q.kept").select(
        *(text.alias(c) if c == "text" else F.col(c) for c in docs.columns))
