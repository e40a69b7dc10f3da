"""Records to tokens, and totals over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.stopwords import STOPWORDS
from linkloom.functions.text import kept_tokens, with_bag
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import lookup_join

# A word takes some tens of bytes, so a broadcast of so many stays below some megabytes.
BROADCAST_STOPWORDS = 100_000


def records(df: DataFrame, src: str, id_col: str, text_col: str = "text") -> DataFrame:
    """A catalogue as (src, id, text); a null text is an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.lit(src).alias("src"), F.col(id_col).alias("id"), text.alias("text"))


def corpus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both catalogues under each other; `src` keeps equal ids apart."""
    return left.unionByName(right)


def duplicate_ids(recs: DataFrame) -> DataFrame:
    """Ids that occur more than once within a catalogue; linkage expects none."""
    return recs.groupBy("src", "id").agg(F.count("*").alias("n")).filter("n > 1")


def tokenize(recs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Replace the text by its token array, without stopwords."""
    return recs.withColumn("tokens", kept_tokens("text", stopwords)).drop("text")


def token_rows(tokenized: DataFrame) -> DataFrame:
    """One row per token occurrence, with its position."""
    others = [c for c in tokenized.columns if c != "tokens"]
    return tokenized.select(*others, F.posexplode_outer("tokens").alias("pos", "token")).filter(
        F.col("token").isNotNull()
    )


def drop_stopword_rows(rows: DataFrame, stopwords: DataFrame, spread_by: str = "id", limit: int = BROADCAST_STOPWORDS) -> DataFrame:
    """The rows whose `token` is not in the table `stopwords`: the list form's filter for a list of any length.

    A table of at most `limit` words is broadcast. A longer one is joined by token; the words with
    the most rows, at most HOT_KEYS, are looked up in a broadcast table then, and the rows of hot
    words are spread by a hash of `spread_by`.
    """
    words = stopwords.select("token").filter("token is not null").distinct()
    if words.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(words), "token", "left_anti").select(*rows.columns)
    words = materialize(words, "stopwords")
    frequency = rows.groupBy("token").agg(F.count("*").alias("_rows"))
    # A hot word that is no stopword must be found not to be one in its many tasks as well.
    lookup = materialize(frequency.join(words.withColumn("_stop", F.lit(True)), "token", "left"), "stopword-rows")
    return lookup_join(rows, lookup, ["token"], "_rows", spread_by).filter("_stop is null").select(*rows.columns)


def token_total(tokenized: DataFrame) -> DataFrame:
    """Token occurrences per catalogue."""
    return tokenized.groupBy("src").agg(
        F.coalesce(F.sum(F.size("tokens")), F.lit(0)).cast("bigint").alias("n_tokens")
    )


def biggest_record(tokenized: DataFrame) -> DataFrame:
    """The record with the most tokens; the smallest id among equals."""
    sized = tokenized.select("src", "id", F.size("tokens").cast("bigint").alias("n_tokens"))
    return sized.orderBy(F.desc("n_tokens"), "id", "src").limit(1)


def bags(tokenized: DataFrame) -> DataFrame:
    """One row per record: its distinct tokens with counts, and its length."""
    return with_bag(tokenized, F.col("tokens")).withColumn("len", F.size("tokens")).drop("tokens")


def postings(bagged: DataFrame) -> DataFrame:
    """One row per record and distinct token, with the count `n`.

    The outer form matters: for the plain one Spark adds a filter on the size of the array
    and pushes it to the scan, where the whole counting would be evaluated once more.
    """
    others = [c for c in bagged.columns if c != "bag"]
    return bagged.select(*others, F.inline_outer("bag")).filter(F.col("token").isNotNull())


def vocabulary(posted: DataFrame) -> DataFrame:
    """Distinct tokens with the number of records that hold them."""
    return posted.groupBy("token").agg(F.count("*").alias("n_docs"))
