"""The registered queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import inputs
from linkloom.functions.sets import hash_family, indicator, token_number
from linkloom.functions.stopwords import STOPWORDS
from linkloom.functions.text import tokens
from linkloom.operators import evaluate, pairs, sets, weights
from linkloom.operators.materialize import materialize, write_lines
from linkloom.operators.tokens import (
    bags,
    biggest_record,
    corpus,
    drop_stopword_rows,
    duplicate_ids,
    postings,
    token_rows,
    token_total,
    tokenize,
    vocabulary,
)
from linkloom.plans import linkage
from linkloom.sources import lines

# The lowest threshold of the curve; similarities below it are never read there.
LOWEST = 0.01
HASHES = hash_family(64)


def _rounded(c: Column | str, digits: int = 9) -> Column:
    return F.round(c, digits)


def _shown(sim: str) -> Column:
    """A similarity, kept with 12 digits, to 9. Not `round`: engines differ on its ties."""
    return F.floor(F.col(sim) * 1e9 + 0.5) / F.lit(1e9)


def _passage_bags(spark: SparkSession, folder: str) -> DataFrame:
    return bags(tokenize(inputs.passage_records(spark, folder)))


def _idf(spark: SparkSession, folder: str, bagged: DataFrame | None = None) -> DataFrame:
    bagged = _passage_bags(spark, folder) if bagged is None else bagged
    return materialize(weights.idf_table(postings(bagged), bagged), "idf")


def _passages(spark: SparkSession, folder: str) -> linkage.Linkage:
    return inputs.passage_link(spark, folder)


def _feeds(spark: SparkSession, folder: str) -> linkage.Linkage:
    return inputs.feed_link(spark, folder)


# Sources


def parse_record_lines(spark, folder):
    return lines.accepted_records(lines.parse_record_lines(inputs.record_lines(spark, folder)))


def parse_status_counts(spark, folder):
    return lines.status_counts(lines.parse_record_lines(inputs.record_lines(spark, folder)))


def parse_rejects(spark, folder):
    return lines.rejects(lines.parse_record_lines(inputs.record_lines(spark, folder)))


def parse_gold_lines(spark, folder):
    return lines.accepted_gold(lines.parse_gold_lines(inputs.gold_lines(spark, folder)))


def _record_feed(spark, folder) -> lines.Feed:
    return lines.read_record_feed(spark, write_lines(inputs.record_lines(spark, folder), "record-lines"))


def scan_records(spark, folder):
    """Records out of text files."""
    return _record_feed(spark, folder).accepted


def scan_rejects(spark, folder):
    return _record_feed(spark, folder).rejected


def scan_counts(spark, folder):
    """Lines by status, counted while the records were read."""
    return lines.feed_counts(spark, _record_feed(spark, folder))


def scan_gold(spark, folder):
    """Gold pairs out of text files, each once."""
    path = write_lines(inputs.gold_lines(spark, folder), "gold-lines")
    return lines.read_gold_feed(spark, path).accepted.distinct()


def csv_records(spark, folder):
    """Records and rejected lines of the same files through the CSV reader."""
    feed = lines.read_csv_feed(spark, write_lines(inputs.csv_lines(spark, folder), "csv-lines"))
    kept = feed.rejected.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("text"), "value")
    return feed.accepted.select("id", "text", F.lit(None).cast("string").alias("value")).unionByName(kept)


# Tokens


def kept_postings(spark, folder):
    """Tokens of documents that are not in a stopword file, with their numbers."""
    stopwords = lines.read_stopwords(spark, write_lines(inputs.stopword_lines(spark), "stopword-lines"))
    rows = postings(bags(tokenize(inputs.document_records(spark, folder), stopwords=())))
    return drop_stopword_rows(rows, stopwords).select("id", "token", F.col("n").cast("bigint").alias("n"))


def stopword_hits(spark, folder):
    rows = token_rows(tokenize(inputs.document_records(spark, folder), stopwords=()))
    return rows.filter(F.col("token").isin(*STOPWORDS)).groupBy("token").agg(F.count("*").alias("n"))


def doc_token_counts(spark, folder):
    every = inputs.document_records(spark, folder).withColumn("n_all", F.size(tokens("text")).cast("bigint"))
    return tokenize(every).select("id", "n_all", F.size("tokens").cast("bigint").alias("n_kept"))


def corpus_token_total(spark, folder):
    return token_total(tokenize(inputs.passage_records(spark, folder)))


def biggest(spark, folder):
    return biggest_record(tokenize(inputs.passage_records(spark, folder))).select("id", "n_tokens")


def repeated_ids(spark, folder):
    return duplicate_ids(inputs.passage_records(spark, folder))


def corpus_vocabulary(spark, folder):
    return vocabulary(postings(_passage_bags(spark, folder)))


# Weights


def term_frequency(spark, folder):
    bagged = bags(tokenize(inputs.document_records(spark, folder)))
    return weights.term_frequency(postings(bagged)).select("id", "token", _rounded("tf").alias("tf"))


def idf_table(spark, folder):
    return _idf(spark, folder).withColumn("idf", _rounded("idf"))


def tfidf_weights(spark, folder):
    bagged = materialize(_passage_bags(spark, folder), "bags")
    weighed = weights.tfidf(postings(bagged), _idf(spark, folder, bagged))
    return weighed.select("src", "id", "token", _rounded("w", 6).alias("w"))


def doc_norms(spark, folder):
    bagged = materialize(_passage_bags(spark, folder), "bags")
    weighed = weights.tfidf(postings(bagged), _idf(spark, folder, bagged))
    return weights.norms(weighed, bagged).withColumn("norm", _rounded("norm", 6))


def idf_histogram(spark, folder):
    return weights.idf_histogram(_idf(spark, folder)).withColumn("rel_freq", _rounded("rel_freq"))


# Pairs


def inverted_index(spark, folder):
    return pairs.posting_counts(postings(_passage_bags(spark, folder)))


def inverted_index_rows(spark, folder):
    return pairs.inverted_index(postings(_passage_bags(spark, folder)))


def adhoc_similarity(spark, folder):
    scored = sets.text_pair_cosine(inputs.turn_pairs(spark, folder), _idf(spark, folder))
    return scored.withColumn("sim", _shown("sim"))


def all_pairs_similarity(spark, folder):
    """Per passage: its similarities to all documents, those without a common token included."""
    link = _passages(spark, folder)
    groups = link.groups
    n_right = groups.filter("src = 'r'").agg(F.sum("n_records")).scalar()
    with_tokens = groups.filter("src = 'r' and len > 0").agg(F.sum("n_records")).scalar()
    sums = pairs.similarity_sums(link.units, groups).withColumnRenamed("l_rep", "rep")
    n_scored = F.when(F.col("len") > 0, with_tokens).otherwise(0)
    mean = F.try_divide(F.coalesce("total", F.lit(0.0)), F.nullif(n_scored, F.lit(0)).cast("double"))
    return (
        linkage.members(link)
        .filter("src = 'l'")
        .join(sums, "rep", "left")
        .select(
            F.col("id").alias("l_id"),
            n_right.alias("n_pairs"),
            n_scored.alias("n_scored"),
            _rounded(mean).alias("avg_sim"),
        )
    )


def similarity_lookup(spark, folder):
    found = linkage.requested(_passages(spark, folder), inputs.passage_gold(spark, folder))
    return found.select("l_id", "r_id", _shown("sim").alias("sim"))


def common_tokens(spark, folder):
    """The tokens that a passage and a document holding it have in common, and their number."""
    gold = materialize(inputs.passage_gold(spark, folder).select("l_id", "r_id"), "gold")
    bagged = materialize(_passage_bags(spark, folder).select("src", "id", F.col("bag")["token"].alias("tokens")), "token-sets")
    both = sets.attach_sides(gold, bagged.filter("src = 'l'"), bagged.filter("src = 'r'"), "tokens")
    common = both.withColumn("common", F.sort_array(F.array_intersect("l_tokens", "r_tokens")))
    return common.select(
        "l_id", "r_id", F.size("common").cast("bigint").alias("n_common"), F.array_join("common", " ").alias("tokens")
    )


def cosine_linkage(spark, folder):
    """Similar pairs at the least similarity that the curve looks at."""
    found = linkage.record_matches(_passages(spark, folder), LOWEST)
    return found.select("l_id", "r_id", _shown("sim").alias("sim"))


def cosine_matches(spark, folder):
    return linkage.record_matches(_passages(spark, folder), 0.05).withColumn("sim", _shown("sim"))


def cosine_group_matches(spark, folder):
    found = linkage.group_matches(_feeds(spark, folder), 0.1)
    return found.withColumn("n_pairs", F.col("n_pairs").cast("bigint")).withColumn("sim", _shown("sim"))


def copy_groups(spark, folder):
    return linkage.members(_feeds(spark, folder)).select("src", "id", "rep", "n_records")


# Evaluation


def _gold_sims(link: linkage.Linkage, gold: DataFrame) -> DataFrame:
    """Gold pairs whose records exist, with `n_pairs` and their similarity, which may be null."""
    gold = materialize(gold, "gold")
    return materialize(linkage.requested(link, gold).join(gold, ["l_id", "r_id"]), "gold-sims")


def gold_duplicates(spark, folder):
    found = _gold_sims(_feeds(spark, folder), inputs.feed_gold(spark, folder))
    return found.select("l_id", "r_id", F.col("n_pairs").cast("bigint").alias("n_pairs"), _shown("sim").alias("sim"))


def non_duplicates(spark, folder):
    """Pairs at LOWEST similarity or more that are not gold: what a threshold would get wrong."""
    sims = linkage.record_matches(_passages(spark, folder), LOWEST).select("l_id", "r_id", _shown("sim").alias("sim"))
    return evaluate.non_duplicates(sims, inputs.passage_gold(spark, folder))


def _evaluate_model(link: linkage.Linkage, gold: DataFrame) -> DataFrame:
    per_side = link.groups.agg(
        *[
            F.sum(F.when((F.col("src") == s) & (F.col("len") > 0), F.col("n_records")).otherwise(0)).alias(s)
            for s in ("l", "r")
        ]
    )
    result = evaluate.evaluate_model(
        _gold_sims(link, gold),
        pairs.total_similarity(link.units, link.groups),
        per_side.select(F.col("l").cast(inputs.COUNT).cast("double") * F.col("r").cast("double")),
    )
    return result.select(F.col("n_dup").cast("bigint").alias("n_dup"), _rounded("avg_dup").alias("avg_dup"), _rounded("avg_nondup").alias("avg_nondup"))


def evaluate_model(spark, folder):
    return _evaluate_model(_passages(spark, folder), inputs.passage_gold(spark, folder))


def evaluate_model_feeds(spark, folder):
    return _evaluate_model(_feeds(spark, folder), inputs.feed_gold(spark, folder))


def _histogram(link: linkage.Linkage) -> DataFrame:
    """(bin, n) of all pairs that have a similarity.

    Pairs from the first hundredth on are found by their minimum similarity; the others are
    what is left of the product of the two catalogues, and need not be formed.
    """
    high = evaluate.bin_histogram(linkage.group_bins(link, LOWEST, evaluate.similarity_bin), "n_pairs").filter("bin > 0")
    high = materialize(high.withColumn("n", F.col("n").cast(inputs.COUNT)), "bins")
    sides = [F.sum(F.when((F.col("src") == s) & (F.col("len") > 0), F.col("n_records"))) for s in ("l", "r")]
    every = link.groups.agg(*[F.coalesce(c, F.lit(0)).cast("decimal(19,0)").alias(s) for c, s in zip(sides, ("l", "r"))])
    rest = every.select((F.col("l") * F.col("r")).cast(inputs.COUNT).alias("n")).unionByName(high.select((-F.col("n")).alias("n")))
    low = rest.agg(F.sum("n").cast(inputs.COUNT).alias("n")).select(F.lit(0).alias("bin"), "n").filter("n > 0")
    return high.select("bin", "n").unionByName(low)


def similarity_histogram(spark, folder):
    return _histogram(_passages(spark, folder)).withColumn("n", F.col("n").cast("bigint"))


def gold_similarity(spark, folder):
    gold = materialize(inputs.passage_gold(spark, folder), "gold")
    sims = evaluate.gold_similarity(gold, linkage.requested(_passages(spark, folder), gold))
    return sims.select("l_id", "r_id", _shown("sim").alias("sim"))


def fp_bins(spark, folder):
    link, gold = _passages(spark, folder), materialize(inputs.passage_gold(spark, folder), "gold")
    gold_sims = _gold_sims(link, gold).filter("sim is not null")
    bins = evaluate.false_positive_bins(_histogram(link), gold_sims)
    return bins.withColumn("n", F.col("n").cast("bigint")).filter("n <> 0")


def _curve(link: linkage.Linkage, gold: DataFrame) -> DataFrame:
    gold = materialize(gold, "gold")
    gold_sims = materialize(evaluate.gold_similarity(gold, linkage.requested(link, gold)), "gold-sims")
    histogram = evaluate.bin_histogram(linkage.group_bins(link, LOWEST, evaluate.similarity_bin), "n_pairs")
    curve = evaluate.threshold_curve(histogram, gold_sims)
    counts = [F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")]
    ratios = [_rounded(c).alias(c) for c in ("precision", "recall", "f")]
    return curve.select("threshold", *counts, *ratios)


def threshold_curve(spark, folder):
    return _curve(_passages(spark, folder), inputs.passage_gold(spark, folder))


def threshold_curve_feeds(spark, folder):
    return _curve(_feeds(spark, folder), inputs.feed_gold(spark, folder))


def threshold_rates(spark, folder):
    """The curve at thresholds off the grid, some of them equal to similarities of gold pairs."""
    link, gold = _passages(spark, folder), materialize(inputs.passage_gold(spark, folder), "gold")
    sims = evaluate.gold_similarity(gold, linkage.requested(link, gold))
    gold_sims = materialize(sims.withColumn("sim", _shown("sim")), "gold-sims")
    rates = evaluate.rates_at(inputs.thresholds(gold_sims), _histogram(link), gold_sims)
    counts = [F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")]
    return rates.select(_rounded("threshold").alias("threshold"), *counts, *[_rounded(c).alias(c) for c in ("precision", "recall", "f")])


# Sets and signatures


def _jaccard(spark, folder, measure: str) -> DataFrame:
    both = sets.text_pair_jaccard(inputs.turn_pairs(spark, folder))
    return both.select("pair_id", _rounded(measure).alias("jaccard"))


def jaccard_set(spark, folder):
    return _jaccard(spark, folder, "jaccard_set")


def jaccard_bag(spark, folder):
    return _jaccard(spark, folder, "jaccard_bag")


def _elements(spark, folder) -> DataFrame:
    return postings(bags(tokenize(inputs.document_records(spark, folder)))).select(
        "id", token_number("token").alias("element")
    )


def element_matrix(spark, folder):
    """Which documents have an element, as rows of a 0/1 matrix with a column a document."""
    bagged = bags(tokenize(inputs.document_records(spark, folder)))
    words = bagged.select("id", F.transform("bag", lambda e: token_number(e["token"])).alias("elements"))
    columns = sets.matrix_columns(inputs.document_records(spark, folder))
    return sets.element_matrix(words, columns)


def minhash_signatures(spark, folder):
    return sets.signature_values(sets.minhash(_elements(spark, folder), HASHES))


def signature_rows(spark, folder):
    values = sets.signature_values(sets.minhash(_elements(spark, folder), HASHES))
    return sets.signature_rows(values).select("id", F.array_join("signature", " ").alias("signature"))


def minhash_estimate(spark, folder):
    """Estimated next to exact Jaccard similarity of the gold pairs of the feeds."""
    bagged = bags(tokenize(inputs.feed_records(spark, folder))).filter("len > 0")
    signed = materialize(sets.record_signatures(bagged, HASHES), "signed")
    gold = materialize(inputs.feed_gold(spark, folder).select("l_id", "r_id"), "gold")
    asked = sets.attach_sides(gold, signed.filter("src = 'l'"), signed.filter("src = 'r'"), "signature")
    return sets.compare_signatures(asked).withColumn("estimate", _rounded("estimate"))


def minhash_error(spark, folder):
    """Estimated beside exact Jaccard similarity of each conversation turn and the next."""
    found = sets.text_pair_minhash(inputs.turn_pairs(spark, folder), HASHES)
    return found.select("pair_id", "n_equal", *[_rounded(c).alias(c) for c in ("jaccard", "estimate", "error")])


def indicator_to_set(spark, folder):
    """Which stopwords a document uses: a 0/1 vector per document, then the set positions."""
    recs = tokenize(inputs.document_records(spark, folder), stopwords=())
    used = F.array_distinct(F.filter("tokens", lambda t: t.isin(*STOPWORDS)))
    listed = F.array(*[F.lit(w) for w in STOPWORDS])
    return sets.indicator_to_set(recs.select("id", indicator(used, listed).alias("v")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_record_lines": parse_record_lines,
    "parse_status_counts": parse_status_counts,
    "parse_rejects": parse_rejects,
    "parse_gold_lines": parse_gold_lines,
    "scan_records": scan_records,
    "scan_rejects": scan_rejects,
    "scan_counts": scan_counts,
    "scan_gold": scan_gold,
    "csv_records": csv_records,
    "kept_postings": kept_postings,
    "stopword_hits": stopword_hits,
    "doc_token_counts": doc_token_counts,
    "token_total": corpus_token_total,
    "biggest_record": biggest,
    "duplicate_ids": repeated_ids,
    "corpus_vocabulary": corpus_vocabulary,
    "term_frequency": term_frequency,
    "idf_table": idf_table,
    "tfidf_weights": tfidf_weights,
    "doc_norms": doc_norms,
    "idf_histogram": idf_histogram,
    "inverted_index": inverted_index,
    "inverted_index_rows": inverted_index_rows,
    "adhoc_similarity": adhoc_similarity,
    "all_pairs_similarity": all_pairs_similarity,
    "similarity_lookup": similarity_lookup,
    "common_tokens": common_tokens,
    "cosine_linkage": cosine_linkage,
    "cosine_matches": cosine_matches,
    "cosine_group_matches": cosine_group_matches,
    "copy_groups": copy_groups,
    "gold_duplicates": gold_duplicates,
    "non_duplicates": non_duplicates,
    "evaluate_model": evaluate_model,
    "evaluate_model_feeds": evaluate_model_feeds,
    "similarity_histogram": similarity_histogram,
    "gold_similarity": gold_similarity,
    "fp_bins": fp_bins,
    "threshold_curve": threshold_curve,
    "threshold_curve_feeds": threshold_curve_feeds,
    "threshold_rates": threshold_rates,
    "jaccard_set": jaccard_set,
    "jaccard_bag": jaccard_bag,
    "element_matrix": element_matrix,
    "minhash_signatures": minhash_signatures,
    "signature_rows": signature_rows,
    "minhash_estimate": minhash_estimate,
    "minhash_error": minhash_error,
    "indicator_to_set": indicator_to_set,
}
