"""Text to tokens, as column expressions that run inside the scan's own tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.stopwords import STOPWORDS


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of ASCII word characters, in order, duplicates kept."""
    return F.array_remove(F.split(F.lower(text), r"\W+", -1), "")


def without_stopwords(token_array: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Drop stopwords from a token array; order and duplicates stay."""
    return F.filter(token_array, lambda t: ~t.isin(*stopwords)) if stopwords else token_array


def kept_tokens(text: Column | str, stopwords: Sequence[str] = STOPWORDS) -> Column:
    return without_stopwords(tokens(text), stopwords)


def strip_quotes(value: Column | str) -> Column:
    return F.translate(value, '"', "")


def with_bag(df: DataFrame, token_array: Column, name: str = "bag") -> DataFrame:
    """Add the token multiset of each row as an array of (token, n), sorted by token.

    The counting happens inside the row: sort the tokens, find where each run starts, and
    take the distance to the next start. No token leaves its task, so term counts cost no
    shuffle. The helper columns are named first so that Spark evaluates each once per row.
    """
    runs = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    empty = F.array().cast("array<struct<token:string,n:int>>")
    bag = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.get("_sorted", start).alias("token"),
            (F.coalesce(F.get("_starts", i + 1), F.size("_sorted")) - start).alias("n"),
        ),
    )
    return (
        df.withColumn("_sorted", F.sort_array(token_array))
        .withColumn("_starts", F.when(F.size("_sorted") > 0, runs))
        .withColumn(name, F.coalesce(bag, empty))
        .drop("_sorted", "_starts")
    )


def with_packed_bag(df: DataFrame, token_array: Column) -> DataFrame:
    """Add `len`, and what `with_bag` adds as a string of the words, which have no blanks, and an array of their counts."""
    n = F.size("_sorted")
    runs = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)))
    ends = F.concat(F.slice("_starts", 2, n), F.array(n))
    none = F.array().cast("array<int>")
    return (
        df.withColumn("_sorted", F.sort_array(token_array))
        .withColumn("_starts", F.when(n > 0, runs))
        .withColumns(
            {
                "len": n,
                "words": F.coalesce(F.array_join(F.array_distinct("_sorted"), " "), F.lit("")),
                "counts": F.coalesce(F.zip_with("_starts", ends, lambda start, end: end - start), none),
            }
        )
        .drop("_sorted", "_starts")
    )
