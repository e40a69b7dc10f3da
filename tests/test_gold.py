"""Gold mappings of short passages and repeated texts, counts beyond a bigint, written tables."""

import pytest
from pyspark.sql import functions as F

from linkloom import inputs
from linkloom.operators import evaluate, pairs
from linkloom.operators.materialize import materialize, scope, shared_folder
from linkloom.operators.tokens import records
from linkloom.plans import linkage

DOCS = [(1, "the blue whale swims"), (2, "Whale!"), (3, "blueish whale"), (4, "same text"), (5, "same text")]
DOCS += [(6, "same text"), (7, "same text"), (8, "same text"), (9, None), (10, "no such")]


@pytest.fixture
def folder(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("documents", DOCS, "doc_id bigint, text string")
    put("benchmark", [(1, "whale"), (2, "blue whale"), (3, "..."), (4, None), (5, "blue text"), (6, "the"), (7, "THE blue"), (8, "of the")], "item_id bigint, text string")
    put("labels", [(4,), (5,), (6,), (1,), (4,)], "doc_id bigint")
    return str(tmp_path)


def test_passages_of_any_length(spark, folder):
    found = sorted((r.l_id, r.r_id, int(r.n_pairs)) for r in inputs.passage_gold(spark, folder).collect())
    assert found == [(1, 1, 1), (1, 2, 1), (1, 3, 1), (2, 1, 1), (6, 1, 1), (7, 1, 1)]


def test_equal_texts_are_counted_many_to_many(spark, folder):
    assert [(r.l_id, r.r_id, int(r.n_pairs)) for r in inputs.feed_gold(spark, folder).collect()] == [(4, 7, 6)]


def test_counts_beyond_a_bigint(spark):
    groups = spark.createDataFrame([("l", 1, 5_000_000_000), ("r", 2, 5_000_000_000)], "src string, rep bigint, n_records bigint")
    link = linkage.Linkage(groups, groups, groups, groups)
    found = spark.createDataFrame([(1, 2, 0.5)], "l_rep bigint, r_rep bigint, sim double")
    counted = linkage._counted(found, link)
    assert int(counted.first().n_pairs) == 25 * 10**18
    histogram = evaluate.similarity_histogram(counted.unionAll(counted), "n_pairs")
    assert int(histogram.first().n) == 50 * 10**18
    gold = counted.select(F.lit(1).alias("l_id"), F.lit(2).alias("r_id"), "sim", "n_pairs")
    half = evaluate.threshold_curve(histogram, gold).filter("threshold = 0.5").first()
    assert (int(half.tp), int(half.fn), int(half.fp)) == (25 * 10**18, 0, 25 * 10**18)


def test_null_text_and_tiny_similarity(spark):
    rows = spark.createDataFrame([(1, None), (2, "a b c"), (3, "")], "id bigint, text string")
    recs = records(rows, "l", "id").unionByName(records(rows, "r", "id"))
    link = linkage.link(recs, ())
    assert {r.len for r in linkage.members(link).filter("id in (1, 3)").collect()} == {0}
    found = pairs.matching_pairs(link.units, 1e-12).collect()
    assert [(r.l_rep, r.r_rep) for r in found] == [(2, 2)]


def test_scope_leaves_nothing(spark):
    with scope(spark) as name:
        table = materialize(spark.range(5), "five")
        assert name in table.inputFiles()[0] and table.count() == 5
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
