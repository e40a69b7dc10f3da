"""Work of the linkages that is done once, or only for what is asked, on rows of the tests' own."""

import re
from collections import Counter

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.text import with_packed_bag
from linkloom.operators import kept, pairs
from linkloom.operators.materialize import settings
from linkloom.operators.tokens import bags, tokenize
from linkloom.plans import linkage
from tests.test_growth import ROWS, make_link


def plan_of(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_texts_are_cut_once(spark):
    """bags of records are written, and both tables are made of them."""
    recs = spark.createDataFrame(ROWS, "src string, id bigint, text string")
    tables = linkage._group_tables(recs, ())
    assert not any("sort_array" in plan_of(tables[t]) for t in ("records", "groups"))
    assert tables["records"].count() == 4 and tables["groups"].count() == 4


def test_packed_bags(spark):
    """as the bags are, copies of words, empty and null texts included."""
    rows = [(1, "b a b c b a"), (2, ""), (3, None), (4, "one"), (5, "x x x"), (6, "The  the, THE!")]
    tokenized = tokenize(spark.createDataFrame(rows, "id int, text string"), ())
    want = {r.id: (r.len, [tuple(e) for e in r.bag]) for r in bags(tokenized).collect()}
    got = {r.id: r for r in with_packed_bag(tokenized, F.col("tokens")).collect()}
    assert want[1] == (6, [("a", 2), ("b", 3), ("c", 1)])
    assert {i: (r.len, list(zip(r.words.split(), r.counts, strict=True))) for i, r in got.items()} == want


def test_shared_tokens_are_not_counted_by_making_them(spark, tmp_path, monkeypatch):
    """the number of buckets comes from the table of tokens."""
    link = make_link(spark, tmp_path, ROWS, "workcount")
    assert pairs.shared_counts(link.tokens) == {"l": 2, "r": 3}

    def never(self):
        raise AssertionError("the rows were made to count them")

    monkeypatch.setattr(DataFrame, "count", never)
    monkeypatch.setattr(type(spark.range(1)), "count", never)
    index = link.index
    monkeypatch.undo()
    assert index.both_l.count() == 2 and index.both_r.count() == 3


def test_vectors_are_summed_and_grouped_once(spark, tmp_path):
    """sorted rows are neither summed in two windows, nor hashed, nor sorted again by record."""
    link = make_link(spark, tmp_path, ROWS, "worksums")
    groups = link.first["groups"]
    with settings(spark, spark_sql_execution_replaceHashWithSortAgg="true"):
        plan = plan_of(linkage._vector_tables(groups, {"l": 2, "r": 2})["vec_r"], "executedPlan")
    top = plan[: plan.index("Window")]
    assert plan.count("Window [") == 1 and "ObjectHashAggregate" not in top and "Sort [" not in top
    assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg") == "false"


def test_rows_of_vectors_are_compiled(spark, tmp_path):
    """words by place; a lambda or zipped arrays would be walked through for each record."""
    index = make_link(spark, tmp_path, ROWS, "workrows").index
    for rows in (index.hot, index.units, pairs.shared_rows(index.kept_l)):
        assert not any(f"{f}(" in plan_of(rows) for f in ("lambdafunction", "arrays_zip"))
    assert Counter(r.token for r in index.units.collect())["both"] == 3


def test_weights_are_made_of_asked_vectors_alone(spark, tmp_path):
    """vectors are multiplied once for a pair, and nothing is made of them below the joins that find those asked for."""
    link = make_link(spark, tmp_path, ROWS, "workasked")
    asked = spark.createDataFrame([(1, 1), (2, 2), (1, 2)], "l_rep bigint, r_rep bigint")
    plan = plan_of(pairs.indexed_scores(asked, link.index))
    assert "lambdafunction" not in plan[plan.index("Join") :] and "split(" not in plan[plan.index("Join") :]
    got = {(r.l_rep, r.r_rep): (r.n_common, r.sim) for r in pairs.indexed_scores(asked, link.index).collect()}
    want = {(r.l_rep, r.r_rep): (r.n_common, r.sim) for r in pairs.score_pairs(asked, link.units).collect()}
    assert got.keys() == want.keys() == {(1, 1), (1, 2)}
    assert all(got[k][0] == n and got[k][1] == pytest.approx(s, abs=1e-11) for k, (n, s) in want.items())


def test_one_id_with_texts_of_several_lengths(spark, tmp_path):
    """each word's weight goes by the length of the text it comes from."""
    rows = [("l", 1, "alpha beta"), ("l", 1, "gamma delta eta theta"), ("r", 2, "alpha zeta"), ("r", 3, "gamma")]
    link = make_link(spark, tmp_path, rows, "worklens")
    assert not pairs.ids_differ(link.groups) and pairs.ids_differ(link.groups.filter("src = 'r'"))
    u = {r.token: r.u for r in link.units.filter("src = 'l'").collect()}
    assert u["alpha"] / u["gamma"] == pytest.approx(2) and u["beta"] / u["delta"] == pytest.approx(2)
    assert {t: x for r in link.index.vec_l.collect() for t, x in zip(r.token, r.u)} == u


def test_ids_are_looked_at_before_words(spark, tmp_path, monkeypatch):
    """where no id has several texts, the words of the vectors are not read to see whether one comes twice."""
    link = make_link(spark, tmp_path, ROWS, "workids")

    def never(vectors):
        raise AssertionError("words were read")

    monkeypatch.setattr(pairs, "words_differ", never)
    assert linkage.group_bins(link, 0.01, lambda sim: F.floor(sim * 100).cast("int")).count() == 2


def test_shared_tokens_are_joined_where_they_lie(spark, tmp_path, monkeypatch):
    """both catalogues have as many buckets, however many more rows one has, and are not sorted again."""
    monkeypatch.setattr(kept, "BUCKET_ROWS", 2)
    rows = [("l", 1, " ".join(f"x{i}" for i in range(30))), *[("r", i, f"x{i} x{i // 2} x{i // 3}") for i in range(30)]]
    link = make_link(spark, tmp_path, rows, "workbuckets")
    index = link.index
    tables = [re.search(r"kept_\w+", plan_of(both)).group() for both in (index.both_l, index.both_r)]
    buckets = [{r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {t}").collect()}["Num Buckets"] for t in tables]
    assert buckets[0] == buckets[1] and int(buckets[0]) > 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with kept.in_order(spark):
            plan = plan_of(pairs.indexed_candidates(index, 0.01), "executedPlan")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [token" in line)
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 2 and not any(word in line for line in lines[join + 1 : scans[1]] for word in ("Exchange", "Sort ["))
    got = {(r.l_id, r.r_id): r.sim for r in linkage.record_matches(link, 0.01).collect()}
    want = {(r.l_rep, r.r_rep): r.sim for r in pairs.sharing_pairs(link.units).collect()}
    assert len(got) == 30 and got == pytest.approx(want, abs=1e-11)
