"""The registered queries of the operators: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import (
    decontaminate,
    extract,
    katz,
    language,
    mixing,
    periods,
    simhash,
    sketches,
    spelling,
    token_files,
    topk,
    toxicity,
    url_rules,
)
from linkloom.llm.common import fold, text_batches

# The rules of the URL query.
RULES = (
    url_rules.Rule("allow", "com/"),
    url_rules.Rule("block", "example.com/en/"),
    url_rules.Rule("allow", "www.example.com/en/"),
    url_rules.Rule("block", "net/es/"),
    url_rules.Rule("block", "net/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn_from_labels(docs.filter(fold("doc_id") != 0), _table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def mix_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id") != 1).alias("train"))
    text_batches(spark)
    scored, total = katz.score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_components(_table(spark, folder, "embeddings"), refuse=True)
    return topk.top_products(vectors, F.pmod("vec_id", F.lit(100)) == 0)


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), unnamed=True)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def token_digest(spark: SparkSession, folder: str) -> DataFrame:
    dictionary, shards = token_files.write_token_files(_table(spark, folder, "documents"), tokenizer_path())
    return token_files.checksums(token_files.read_token_files(dictionary, shards))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(_table(spark, folder, "pages"), RULES)


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, folder, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.learn(language.training_fold(docs, fold("doc_id")))
    found = language.predict(docs, model)
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        F.size("languages").alias("n_languages"),
    )


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(_table(spark, folder, "pages")).withColumn("n_chars", extract.n_chars())


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.edited_words(_table(spark, folder, "documents"))
    return spelling.variants(words.filter((F.char_length("word") >= 7) & (F.col("n") >= 2)))


def word_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.periodic_runs(_table(spark, folder, "documents"), seeded=True)
    best = periods.strongest()
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periods.listed(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = sketches.versions(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxic,
    "op2_mixing": mix_plan,
    "op3_katz": katz_scores,
    "op4_topk": top_k,
    "op5_decontaminate": leaks,
    "op6_token_files": token_digest,
    "op7_url_rules": url_verdicts,
    "op8_simhash": near_duplicates,
    "op9_language": languages,
    "op10_main_text": main_texts,
    "op11_spelling": spelling_variants,
    "op12_periods": word_periods,
    "op13_fingerprints": document_fingerprints,
}
