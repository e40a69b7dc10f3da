"""Term frequency, inverse document frequency, weights and norms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.skew import lookup_join


def term_frequency(posted: DataFrame) -> DataFrame:
    """Share of a token among the record's tokens."""
    return posted.withColumn("tf", F.col("n") / F.col("len")).drop("n", "len")


def idf_table(posted: DataFrame, recs: DataFrame) -> DataFrame:
    """(token, df, idf): idf is the number of records over df, without a logarithm.

    Records without any token count as records too, so the total is taken from `recs`.
    """
    n_records = recs.agg(F.count("*").cast("double")).scalar()
    return (
        posted.groupBy("token")
        .agg(F.count("*").alias("df"))
        .withColumn("idf", n_records / F.col("df"))
    )


def tfidf(posted: DataFrame, idf: DataFrame) -> DataFrame:
    """Weight `w` of every posting; a token missing from `idf` weighs 0."""
    weighed = lookup_join(term_frequency(posted), idf, ["token"], "df", "id")
    return weighed.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(0.0))).drop("tf", "df", "idf")


def norms(weights: DataFrame, bagged: DataFrame) -> DataFrame:
    """Euclidean length of each record's weight vector; 0 for a record without tokens."""
    tokenless = bagged.filter("len = 0").select("src", "id", F.lit(0.0).alias("norm"))
    return (
        weights.groupBy("src", "id")
        .agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        .unionByName(tokenless)
    )


def idf_histogram(idf: DataFrame, bins: int = 50) -> DataFrame:
    """Relative frequency of IDF values in equal bins between the smallest and the largest.

    Tokens of equal df share their idf, so they are counted together first; what is left
    has one row per distinct df.
    """
    levels = idf.groupBy("idf").agg(F.count("*").alias("n"))
    lo = levels.agg(F.min("idf")).scalar()
    hi = levels.agg(F.max("idf")).scalar()
    total = levels.agg(F.sum("n")).scalar()
    position = F.floor((F.col("idf") - lo) * bins / F.nullif(hi - lo, F.lit(0.0)))
    bucket = F.coalesce(F.least(position + 1, F.lit(bins)), F.lit(1)).cast("int")
    return (
        levels.groupBy(bucket.alias("bucket"))
        .agg(F.sum("n").alias("n"))
        .select("bucket", (F.col("n") / total).alias("rel_freq"))
    )
