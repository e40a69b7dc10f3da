"""Work and space that must not grow faster than the tables, on rows of the tests' own."""

import os
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from linkloom.functions.sets import hash_family, indicator, signature, token_number
from linkloom.operators import evaluate, pairs, sets
from linkloom.operators.materialize import shared_folder
from linkloom.operators.skew import frequent_join
from linkloom.operators.tokens import bags, tokenize
from linkloom.plans import linkage


def test_indicator_makes_its_set_once(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id int, text string")
    used, listed = F.array_distinct(F.split("text", " ")), F.array(*[F.lit(x) for x in "cba"])
    vectors = rows.select("id", indicator(used, listed).alias("v"))
    assert {r.id: r.v for r in vectors.collect()} == {1: [0, 1, 1], 2: [0, 0, 0], 3: [None, None, None]}
    from linkloom.queries import QUERIES

    plan = QUERIES["indicator_to_set"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains(" in plan and "array_contains(array_distinct" not in plan


def test_record_signatures(spark):
    """A row for each record, copies of an id included, and as the signature made inside the row."""
    hashes = hash_family(8)
    rows = [("l", 1, "alpha beta"), ("l", 1, "alpha beta"), ("l", 1, "gamma"), ("r", 1, "beta"), ("r", None, "beta delta"), ("r", 2, "")]
    bagged = bags(tokenize(spark.createDataFrame(rows, "src string, id int, text string"), ()))
    got = sets.record_signatures(bagged, hashes)
    numbers = F.transform("bag", lambda e: token_number(e["token"]))
    want = bagged.filter("len > 0").select("src", "id", numbers.alias("e")).select("src", "id", signature(F.col("e"), hashes).alias("signature"))
    found = lambda df: Counter((r.src, r.id, tuple(r.signature)) for r in df.collect())
    assert found(got) == found(want) and got.count() == 5


def kept_parts(spark, name):
    folder = f"{shared_folder(spark)}/linkloom-kept"
    return {re.sub(r"-[0-9a-f]{32}$", "", x) for x in os.listdir(folder) if x.startswith(name)}


def make_link(spark, tmp_path, rows, name):
    path = f"{tmp_path}/{name}"
    spark.createDataFrame(rows, "src string, id bigint, text string").write.mode("overwrite").parquet(path)
    return linkage.kept_link(spark, name, [path], lambda: spark.read.parquet(path), ())


ROWS = [("l", 1, "both left left2 two"), ("l", 2, "left"), ("r", 1, "both right right2 two"), ("r", 2, "both")]


def test_parts_are_kept_when_asked_for(spark, tmp_path):
    link = make_link(spark, tmp_path, ROWS, "growparts")
    assert linkage.members(link).count() == 4
    assert kept_parts(spark, "growparts") == {"growparts"}
    asked = spark.createDataFrame([(1, 1), (2, 2)], "l_id bigint, r_id bigint")
    assert {(r.l_id, r.r_id): r.n_common for r in linkage.requested(link, asked).collect()} == {(1, 1): 2, (2, 2): 0}
    assert kept_parts(spark, "growparts") == {"growparts", "growparts-vectors"}
    assert linkage.record_matches(link, 0.01).count() == 2
    assert kept_parts(spark, "growparts") == {"growparts", "growparts-vectors", "growparts-shared"}


def test_tokens_of_one_side_are_not_dealt_by_token(spark, tmp_path):
    index = make_link(spark, tmp_path, ROWS, "growsides").index
    assert index.both_l.count() == 2 and index.both_r.count() == 3
    bounds = index.both_l.join(index.cold_l.withColumn("token_hash", F.xxhash64("token")).withColumnsRenamed({"u": "exact"}).drop("tail"), ["rep", "token_hash"])
    assert bounds.count() == 2 and bounds.filter("u < exact or u > exact * 1.00001").isEmpty()


def test_parts_belong_to_the_files_first_read(spark, tmp_path):
    old = make_link(spark, tmp_path, ROWS, "growstamp")
    new = make_link(spark, tmp_path, [*ROWS, ("r", 9, "quite another text")], "growstamp")
    assert old.units.count() + 3 == new.units.count()


def test_frequent_join(spark, monkeypatch):
    from linkloom.operators import skew

    monkeypatch.setattr(skew, "FREQUENT_KEYS", 4)
    rows = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("key"))
    lookup = rows.filter("key <> 'k3'").groupBy("key").agg(F.count("*").alias("n"))
    got = frequent_join(rows, lookup, "key", "n")
    want = rows.join(lookup, "key")
    assert got.select("id", "key", "n").exceptAll(want.select("id", "key", "n")).isEmpty() and got.count() == want.count() == 57


def test_upper_is_no_less(spark):
    values = spark.range(1, 2000).select((1 / F.col("id")).alias("x"))
    assert values.filter(pairs.upper(F.col("x")).cast("double") < F.col("x")).isEmpty()


def test_text_slices_are_small():
    from linkloom.llm import token_files

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": ["x" * 100_000] * 100})
    slices = list(token_files._slices(batch))
    assert sum(s.num_rows for s in slices) == 100 and max(s.num_rows for s in slices) <= 45


def test_vectors_are_dealt_by_their_entries(spark, tmp_path, monkeypatch):
    """A task has few enough entries to sort them in memory, and only rare words' rows are moved."""
    from linkloom.operators import skew

    monkeypatch.setattr(linkage, "VECTOR_ENTRIES", 5)
    monkeypatch.setattr(skew, "FREQUENT_KEYS", 12)
    rows = [(src, i, f"common w{i % 3} {src}{i}") for src in "lr" for i in range(20)]
    link = make_link(spark, tmp_path, rows, "growdealt")
    groups = link.first["groups"]
    parts = linkage._vector_parts(groups)
    assert parts == {"l": 12, "r": 12}
    table = re.search(r"kept_\w+", link.index.vec_l._jdf.queryExecution().optimizedPlan().toString()).group()
    buckets = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}["Num Buckets"]
    assert int(buckets) == 12
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = linkage._vector_tables(groups, parts)["vec_l"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # What is above the join with the lists of rare words stays in its task.
    assert "Exchange hashpartitioning" not in plan[plan.index("Window") : plan.index("SortMergeJoin [rep")]
    got = {r.rep: sorted(zip(r.token, r.tail)) for r in link.index.vec_r.collect()}
    assert got.keys() == set(range(20)) and all([t for t, _ in v] == sorted(["common", f"w{i % 3}", f"r{i}"]) for i, v in got.items())
    # From common to rare the tails grow up to the whole vector.
    assert all(v[0][1] < v[2][1] < v[1][1] and 1 <= v[1][1] < 1.00001 for v in got.values())
    assert linkage.record_matches(link, 0.0001).count() == 400


def binned_rows():
    """Records with words of all degrees of rarity, so that similarities lie in many bins, some on an edge."""
    dealt = random.Random(6)
    words = [f"w{int(200 * dealt.random() ** 3)}" for _ in range(4000)]
    texts = [" ".join(dealt.sample(words, dealt.randint(1, 14))) for _ in range(120)]
    return [("l" if i % 3 else "r", i, t) for i, t in enumerate(texts)] + [("l", 200, texts[0]), ("r", 201, texts[1]), ("r", 202, texts[1])]


def histogram_of(link, found):
    bins = found.groupBy("bin").agg(F.sum("n_pairs").cast("int").alias("n"), F.count("*").alias("groups"))
    return {r.bin: (r.n, r.groups) for r in bins.collect()}


def counting_scores(monkeypatch):
    asked, score = [], pairs.indexed_scores
    monkeypatch.setattr(pairs, "indexed_scores", lambda rows, index: asked.append(rows.count()) or score(rows, index))
    return asked


def test_curve_scores_pairs_at_bin_edges_alone(spark, tmp_path, monkeypatch):
    from linkloom import queries

    link = make_link(spark, tmp_path, binned_rows(), "growbins")
    matches = linkage.group_matches(link, queries.LOWEST)
    want = histogram_of(link, matches.withColumn("bin", evaluate.similarity_bin("sim")))
    assert len(want) > 10 and 100 in want
    gold = spark.createDataFrame([(200, 0, 1), (1, 201, 2)], "l_id bigint, r_id bigint, n_pairs bigint")
    asked = counting_scores(monkeypatch)
    curve = {round(r.threshold * 100): (r.tp, r.fp, r.fn) for r in queries._curve(link, gold).collect()}
    # The gold pairs first, then what the bounds leave open.
    assert asked[0] == 2 and sum(asked[1:]) < matches.count() / 2
    for step in (1, 2, 7, 50, 100):
        above = sum(n for b, (n, _) in want.items() if b >= step)
        assert curve[step] == (3, above - 3, 0)
    assert histogram_of(link, linkage.group_bins(link, queries.LOWEST, evaluate.similarity_bin)) == want


def test_bins_where_hashes_are_the_same(spark, tmp_path, monkeypatch):
    """Words of one hash seem common to records that do not share them; no bin is taken for known then."""
    link = make_link(spark, tmp_path, binned_rows(), "growhash")
    want = histogram_of(link, linkage.group_matches(link, 0.05).withColumn("bin", evaluate.similarity_bin("sim")))
    monkeypatch.setattr(pairs, "token_hash", lambda token: F.pmod(F.xxhash64(token), F.lit(20)))
    path = [f"{tmp_path}/growhash"]
    same = linkage.kept_link(spark, "growhash-20", path, lambda: spark.read.parquet(*path), ())
    assert not pairs.hashes_differ(same.tokens)
    assert histogram_of(same, linkage.group_bins(same, 0.05, evaluate.similarity_bin)) == want


def test_bins_where_an_id_has_several_texts(spark, tmp_path, monkeypatch):
    """Its vector may hold a word twice; no bin is taken for known then."""
    rows = [("l", 1, "alpha beta"), ("l", 1, "alpha gamma"), ("l", 2, "delta beta"), ("r", 3, "delta zeta eta"), ("r", 4, "eta theta")]
    link = make_link(spark, tmp_path, rows, "growtwice")
    assert not pairs.words_differ(link.index.vec_l) and pairs.words_differ(link.index.vec_r)
    asked = counting_scores(monkeypatch)
    assert linkage.group_bins(link, 0.01, evaluate.similarity_bin).count() == linkage.group_matches(link, 0.01).count() == 1
    assert asked == [1, 1]
