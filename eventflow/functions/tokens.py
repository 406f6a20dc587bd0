"""Tokenisers and string splits (O-R4 .. O-R7), all JVM-side.

JVM ``String.split(regex)`` drops trailing empty strings, while Spark's
``split`` keeps them (limit -1). ``jvm_split`` reproduces the JVM behaviour:
trailing delimiters are stripped before the split, an input consisting only of
delimiters gives an empty array, and the empty string gives ``[""]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stop words removed by the stop-word word count (O-R6).
STOP_WORDS = ("a", "an", "the")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_split(c, pattern: str) -> Column:
    c = _c(c)
    stripped = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern)))


def split_explode(df: DataFrame, col: str, pattern: str, out: str = "part",
                  keep: tuple = ()) -> DataFrame:
    """O-R4: one row per part of ``col.split(pattern)`` (JVM semantics)."""
    return df.select(*keep, F.explode(jvm_split(col, pattern)).alias(out))


def word_tokens(df: DataFrame, col: str, out: str = "word", keep: tuple = ()) -> DataFrame:
    """O-R5: lower-case, split on ``\\W+`` (ASCII word characters), drop empties."""
    return (df.select(*keep, F.explode(F.split(F.lower(F.col(col)), r"\W+")).alias(out))
              .filter(F.col(out) != ""))


def stopword_tokens(df: DataFrame, col: str, out: str = "word", keep: tuple = (),
                    stop_words=STOP_WORDS) -> DataFrame:
    """O-R6: split on a single space, drop empties, lower-case, drop stop words."""
    return (df.select(*keep, F.explode(F.split(F.col(col), " ")).alias("_w"))
              .filter(F.col("_w") != "")
              .select(*keep, F.lower("_w").alias(out))
              .filter(~F.col(out).isin(*stop_words)))


def whitespace_tokens(df: DataFrame, col: str, out: str = "word", keep: tuple = ()) -> DataFrame:
    """O-R7: lines split on ``\\n`` (the socket-style record delimiter), each
    line split on a single ``\\s`` keeping interior empty tokens."""
    lines = df.select(*keep, F.explode(F.split(F.col(col), "\n")).alias("_line"))
    return lines.select(*keep, F.explode(jvm_split("_line", r"\s")).alias(out))
