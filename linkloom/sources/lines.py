"""Delimited text lines to records, gold pairs, rejects and stopwords."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import strip_quotes
from linkloom.operators.materialize import materialize

# The two line formats and their header ids.
RECORD_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)\z'
GOLD_PATTERN = r'^(.+),"(.+)\z'
RECORD_HEADER_ID = '"id"'
GOLD_HEADER_ID = '"idAmazon"'


STATUSES = ("ok", "header", "failed")


@dataclass(frozen=True)
class Feed:
    """Files of lines that have been read once.

    accepted  the fields of the lines that could be parsed (written table)
    rejected  the lines that could not, as `value` (the same written table)
    counts    status -> lines, counted while the table was written
    """

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _fields(line: Column, pattern: str, count: int) -> Column:
    """All groups of a whole-line pattern from one regex pass, NULL where it does not match.

    The groups are written out separated by a line feed. A line has none, and `.` matches
    none, so the separator cannot occur inside a field.
    """
    joined = F.regexp_replace(line, pattern, "\n".join(f"${i + 1}" for i in range(count)))
    return F.when(F.instr(line, "\n") == 0, F.split(joined, "\n", -1))


def _status(fields: Column, count: int, header_id: str) -> Column:
    return (
        F.when(F.coalesce(F.size(fields) != count, F.lit(True)), "failed")
        .when(F.get(fields, 0) == header_id, "header")
        .otherwise("ok")
    )


def parse_record_lines(lines: DataFrame) -> DataFrame:
    """(value, status, id, text) for every line; id and text only where status is `ok`.

    A line holds id, quoted title, description, manufacturer and price. The text is the
    title, description and manufacturer; the price is not used.
    """
    parts = lines.select("value", _fields(F.col("value"), RECORD_PATTERN, 5).alias("f"))
    parts = parts.withColumn("status", _status(F.col("f"), 5, RECORD_HEADER_ID))
    ok = F.col("status") == "ok"
    text = F.concat_ws(" ", F.get("f", 1), F.get("f", 2), F.get("f", 3))
    return parts.select(
        "value",
        "status",
        F.when(ok, strip_quotes(F.get("f", 0))).alias("id"),
        F.when(ok, text).alias("text"),
    )


def parse_gold_lines(lines: DataFrame) -> DataFrame:
    """(value, status, l_id, r_id) for every line of a mapping file."""
    parts = lines.select("value", _fields(F.col("value"), GOLD_PATTERN, 2).alias("f"))
    parts = parts.withColumn("status", _status(F.col("f"), 2, GOLD_HEADER_ID))
    ok = F.col("status") == "ok"
    return parts.select(
        "value",
        "status",
        F.when(ok, strip_quotes(F.get("f", 0))).alias("l_id"),
        F.when(ok, strip_quotes(F.get("f", 1))).alias("r_id"),
    )


def accepted_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "ok").select("id", "text")


def accepted_gold(parsed: DataFrame) -> DataFrame:
    """Gold pairs, each once: a repeated pair must not count twice."""
    return parsed.filter(F.col("status") == "ok").select("l_id", "r_id").distinct()


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "failed").select("value")


def reject_sample(parsed: DataFrame, n: int = 10) -> DataFrame:
    return rejects(parsed).limit(n)


def status_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("status").agg(F.count("*").alias("n"))


def load(parsed: DataFrame, name: str) -> Feed:
    """Read parsed lines once: accepted and rejected ones go to folders of one table by status, and
    the statuses are counted in passing."""
    seen = Observation(name)
    counted = parsed.observe(seen, *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    # An accepted line is in its fields, so only the others are written as they came.
    kept = counted.withColumn("value", F.when(F.col("status") != "ok", F.col("value")))
    table = materialize(kept, name, partition_by="status")
    fields = [c for c in parsed.columns if c not in ("value", "status")]
    return Feed(table.filter(F.col("status") == "ok").select(*fields), rejects(table), dict(seen.get))


def read_record_feed(spark: SparkSession, path: str) -> Feed:
    return load(parse_record_lines(read_lines(spark, path)), "record-feed")


def read_gold_feed(spark: SparkSession, path: str) -> Feed:
    """A mapping file; `accepted` has every pair as often as the file has it."""
    return load(parse_gold_lines(read_lines(spark, path)), "gold-feed")


def feed_counts(spark: SparkSession, feed: Feed) -> DataFrame:
    """(status, n) of the statuses that occur."""
    rows = [(status, n) for status, n in feed.counts.items() if n]
    return spark.createDataFrame(rows, "status string, n bigint")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return accepted_records(parse_record_lines(read_lines(spark, path)))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return accepted_gold(parse_gold_lines(read_lines(spark, path)))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One stopword per line, each once."""
    return read_lines(spark, path).select(F.col("value").alias("token")).distinct()


# Fixed value: the columns of a record line.
CSV_SCHEMA = "id string, title string, description string, manufacturer string, price string, value string"


def parse_record_csv(spark: SparkSession, path: str) -> DataFrame:
    """(value, status, id, text) of record files through Spark's CSV reader, which honours quoted commas.

    `value` is the line where it does not hold five fields, else null. Header lines are known by
    their id and not by their place, as every file of a folder may have one or none. Empty lines
    are no rows to the reader.
    """
    # The reader counts the fields of a line only if it reads all of them.
    reader = spark.read.option("columnPruning", False)
    rows = reader.csv(path, schema=CSV_SCHEMA, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="value")
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "description", "manufacturer")]
    status = (
        F.when(F.col("value").isNotNull(), "failed").when(F.col("id") == RECORD_HEADER_ID.strip('"'), "header").otherwise("ok")
    )
    ok = F.col("status") == "ok"
    return rows.withColumn("status", status).select(
        "value", "status", F.when(ok, F.col("id")).alias("id"), F.when(ok, F.concat_ws(" ", *parts)).alias("text")
    )


def read_csv_feed(spark: SparkSession, path: str) -> Feed:
    return load(parse_record_csv(spark, path), "csv-feed")


def read_record_csv(spark: SparkSession, path: str) -> DataFrame:
    return accepted_records(parse_record_csv(spark, path))
