"""The tables that the registered queries run on, always whole.

Two pairs of catalogues are linked:

* passages: `benchmark` (l) against `documents` (r). A gold pair is a document that
  contains a passage word for word.
* feeds: the documents with a label (l) against those without one (r), together all of
  `documents`. Gold pairs are all pairs with equal text, held as one row per text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions.stopwords import STOPWORDS
from linkloom.functions.text import tokens, without_stopwords
from linkloom.operators.kept import kept
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import block_join, lookup_join
from linkloom.operators.tokens import corpus, records
from linkloom.plans import linkage
from linkloom.sources.tables import read_table

# Products of counts: 5e9 times 5e9 does not fit a bigint.
COUNT = "decimal(38,0)"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/documents.parquet", ["doc_id", "text"])


def passages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/benchmark.parquet", ["item_id", "text"])


def passage_records(spark: SparkSession, folder: str) -> DataFrame:
    return corpus(
        records(passages(spark, folder), "l", "item_id"), records(documents(spark, folder), "r", "doc_id")
    )


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    return records(documents(spark, folder), "r", "doc_id")


def feed_records(spark: SparkSession, folder: str) -> DataFrame:
    labelled = (
        spark.read.parquet(f"{folder}/labels.parquet").select("doc_id").distinct().withColumn("labelled", F.lit(True))
    )
    src = F.when(F.col("labelled"), "l").otherwise("r")
    return documents(spark, folder).join(labelled, "doc_id", "left").select(
        src.alias("src"), F.col("doc_id").alias("id"), "text"
    )


def passage_paths(folder: str) -> list[str]:
    return [f"{folder}/{t}.parquet" for t in ("benchmark", "documents")]


def feed_paths(folder: str) -> list[str]:
    return [f"{folder}/{t}.parquet" for t in ("documents", "labels")]


def passage_link(spark: SparkSession, folder: str) -> linkage.Linkage:
    return linkage.kept_link(spark, "passages", passage_paths(folder), lambda: passage_records(spark, folder))


def feed_link(spark: SparkSession, folder: str) -> linkage.Linkage:
    return linkage.kept_link(spark, "feeds", feed_paths(folder), lambda: feed_records(spark, folder))


def passage_gold(spark: SparkSession, folder: str) -> DataFrame:
    """(l_id, r_id, n_pairs = 1): passages and the documents that hold all their words in a row.

    Found once for the tables as they are, and kept.
    """
    build = lambda: {"gold": _passage_gold(spark, folder)}
    return kept(spark, "passage-gold", passage_paths(folder), build, {})["gold"]


def _padded(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, words, name): the words, and all of them in a line with a blank on either side."""
    words = tokens(F.coalesce("text", F.lit("")))
    line = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    return df.select(key, words.alias("words")).withColumn(name, line)


def _passage_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of a passage is a word of the documents that hold it, so only those with the rarest
    of them are searched, and only their texts are looked at. The linkage says which they are; a passage
    of stopwords alone, which it has no words of, is looked for by its rarest stopword. A passage
    without words has no pairs."""
    link = passage_link(spark, folder)
    items = materialize(_padded(passages(spark, folder), "item_id", "passage").filter(F.size("words") > 0), "passage-words")
    rare = _by_rarest_word(items, link)
    plain = items.filter(F.size(without_stopwords(F.col("words"))) == 0)
    if not plain.isEmpty():
        rare = rare.unionByName(_by_rarest_stopword(plain, documents(spark, folder)))
    candidates = materialize(rare, "passage-candidates")
    passage_rows = candidates.groupBy("item_id").agg(F.count("*").alias("_rows"))
    passage_lines = items.select("item_id", "passage").join(passage_rows, "item_id")
    doc_rows = candidates.groupBy("doc_id").agg(F.count("*").alias("_rows"))
    searched = documents(spark, folder).join(doc_rows, "doc_id")
    doc_lines = _padded(searched, "doc_id", "line").drop("words").join(doc_rows, "doc_id")
    with_passage = lookup_join(candidates, passage_lines, ["item_id"], "_rows", "doc_id", "inner").drop("_rows")
    return (
        lookup_join(with_passage, doc_lines, ["doc_id"], "_rows", "item_id", "inner")
        .filter(F.contains("line", "passage"))
        .select(F.col("item_id").alias("l_id"), F.col("doc_id").alias("r_id"), F.lit(1).cast(COUNT).alias("n_pairs"))
    )


def _by_rarest_word(items: DataFrame, link: linkage.Linkage) -> DataFrame:
    """(item_id, doc_id): the documents with that word of a passage that the fewest have."""
    words = items.select("item_id", F.explode_outer(F.array_distinct(without_stopwords(F.col("words")))).alias("token"))
    words = materialize(words.filter("token is not null"), "passage-tokens")
    # Each word of the passages once, with the numbers of passages and of documents' groups that have it.
    asked = words.groupBy("token").agg(F.count("*").alias("_rows")).join(link.tokens.select("token", "n_right"), "token")
    counted = lookup_join(words, materialize(asked, "asked-tokens"), ["token"], "_rows", "item_id", "inner")
    anchors = counted.groupBy("item_id").agg(F.min(F.struct("n_right", "token")).alias("a"))
    anchors = materialize(anchors.filter("a.n_right > 0").select("item_id", "a.token", "a.n_right"), "anchors")
    # Documents of the rarer words are found bucket by bucket; those of hot ones in blocks.
    # By hash: another word of the same hash adds documents that do not hold the passage.
    hashed = anchors.select("item_id", F.xxhash64("token").alias("token_hash"))
    cold = link.index.both_r.select("rep", "token_hash").join(hashed, "token_hash")
    hot_rows = link.index.hot.filter("src = 'r'").select("rep", "token")
    hot = block_join(hot_rows, anchors.select("item_id", "token"), ["token"], "rep", "item_id")
    groups = cold.select("item_id", "rep").unionByName(hot.select("item_id", "rep"))
    members = linkage.members(link).filter("src = 'r'").select("rep", F.col("id").alias("doc_id"))
    sizes = link.groups.filter("src = 'r'").select("rep", F.col("n_records").alias("rows"))
    found = block_join(materialize(groups, "passage-groups"), members, ["rep"], "item_id", "doc_id", right_sizes=sizes)
    return found.select("item_id", "doc_id")


def _by_rarest_stopword(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(item_id, doc_id): the documents with that word of a passage that the fewest have, among stopwords."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    used = F.array_intersect(tokens(F.coalesce("text", F.lit(""))), stop)
    found = materialize(docs.select("doc_id", F.explode(used).alias("word")), "stopwords-used")
    counts = found.groupBy("word").agg(F.count("*").alias("df"))
    asked = items.select("item_id", F.explode(F.array_distinct("words")).alias("word"))
    # At most as many words as there are stopwords.
    counted = asked.join(F.broadcast(counts), "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    anchors = counted.groupBy("item_id").agg(F.min(F.struct("df", "word")).alias("a")).filter("a.df > 0")
    anchors = anchors.select("item_id", "a.word")
    return block_join(found, anchors, ["word"], "doc_id", "item_id").select("item_id", "doc_id")


def feed_gold(spark: SparkSession, folder: str) -> DataFrame:
    """(l_id, r_id, n_pairs): for each text on both sides the first document of either side, and
    how many pairs of documents have that text. Copies are counted, not listed."""
    side = lambda s: F.when(F.col("src") == s, F.col("id"))
    texts = feed_records(spark, folder).withColumn("text", F.sha2(F.coalesce("text", F.lit("")), 256)).groupBy("text").agg(
        *[F.min(side(s)).alias(f"{s}_id") for s in ("l", "r")],
        *[F.count(side(s)).cast(COUNT).alias(f"n_{s}") for s in ("l", "r")],
    )
    pairs = texts.filter("n_l > 0 and n_r > 0")
    return pairs.select("l_id", "r_id", (F.col("n_l") * F.col("n_r")).cast(COUNT).alias("n_pairs"))


def turn_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation turn with the turn after it: (pair_id, text_l, text_r)."""
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "text")
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    after = turns.withColumn("next", F.lead("turn").over(by_turn)).withColumn("text_r", F.lead("text").over(by_turn))
    return after.filter(F.col("next") == F.col("turn") + 1).select(
        F.concat_ws("-", "conv_id", "turn").alias("pair_id"), F.col("text").alias("text_l"), "text_r"
    )


def record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The `part` table as delimited lines, with a header and the line forms that go wrong.

    The part's size decides the form: an unquoted title, a comma within the title, the
    description or the manufacturer, a quote within the description, or the plain form.
    """
    parts = spark.read.parquet(f"{folder}/part.parquet")
    key, name = F.col("p_partkey").cast("string"), F.col("p_name")
    brand, price = F.col("p_brand"), F.col("p_retailprice").cast("string")

    def line(fmt: str):
        return F.format_string(fmt, key, name, brand, price)

    value = (
        F.when(F.col("p_size") > 45, line('"%1$s",%2$s,,"%3$s",%4$s'))
        .when(F.col("p_size") > 40, line('"%1$s","%2$s","a, b, c","%3$s",%4$s'))
        .when(F.col("p_size") > 35, line('"%1$s","%2$s","a "", x","%3$s",%4$s'))
        .when(F.col("p_size") > 30, line('"%1$s","ti, %2$s","desc","m,%3$s",%4$s'))
        .otherwise(line('"%1$s","%2$s",,"%3$s",%4$s'))
    )
    header = spark.range(1).select(F.lit('"id","title","description","manufacturer","price"').alias("value"))
    return header.unionByName(parts.select(value.alias("value")))


def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    """`record_lines`, and lines with too few or too many fields for parts of some sizes."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    key, name = F.col("p_partkey").cast("string"), F.col("p_name")
    broken = F.when(F.col("p_size") <= 2, F.format_string('"%s","%s"', key, name)).when(
        F.col("p_size") <= 4, F.format_string('"%s","%s",,,1,2', key, name)
    )
    return record_lines(spark, folder).unionByName(parts.select(broken.alias("value")).filter("value is not null"))


def stopword_lines(spark: SparkSession) -> DataFrame:
    """The stopwords as the lines of a file."""
    return spark.createDataFrame([(w,) for w in STOPWORDS], "value string")


def thresholds(gold_sims: DataFrame) -> DataFrame:
    """Thresholds on and off the grid: every similarity of a gold pair, and what lies beside it."""
    spark = gold_sims.sparkSession
    met = gold_sims.filter("sim > 0").select(F.col("sim").alias("threshold"))
    beside = met.select(F.explode(F.array(F.col("threshold") / 7, (F.col("threshold") + 6) / 7)).alias("threshold"))
    sevenths = spark.range(1, 8).select((F.col("id") / F.lit(7.0)).alias("threshold"))
    return met.unionByName(beside).unionByName(sevenths).distinct()


def gold_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The gold pairs of the feeds as mapping lines, a header, and broken lines for some."""
    pairs = feed_gold(spark, folder)
    header = spark.range(1).select(F.lit('"idAmazon","idGoogleBase"').alias("value"))
    good = pairs.select(F.format_string('"%s","%s"', "l_id", "r_id").alias("value"))
    broken = pairs.filter("l_id > r_id").select(F.format_string("%s;%s", "l_id", "r_id").alias("value"))
    return header.unionByName(good).unionByName(broken)
