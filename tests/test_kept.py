"""Linkages that are kept in bucketed tables and opened again."""

import re

import pytest
from pyspark.sql import functions as F

from linkloom import inputs
from linkloom.operators import kept, pairs, skew
from linkloom.operators.materialize import scope
from linkloom.plans import linkage
from tests.test_linkage import STOP, as_dict, brute_force, make_records, same


def keep(spark, tmp_path, rows, name="case"):
    spark.createDataFrame(rows, "src string, id bigint, text string").write.mode("overwrite").parquet(f"{tmp_path}/{name}")
    path = f"{tmp_path}/{name}"
    return linkage.kept_link(spark, name, [path], lambda: spark.read.parquet(path), STOP)


@pytest.fixture(params=[4096, 3])
def case(spark, request, tmp_path, monkeypatch):
    """With three rows a block nearly all words and records are hot."""
    monkeypatch.setattr(pairs, "BLOCK_ROWS", request.param)
    monkeypatch.setattr(skew, "BLOCK_ROWS", request.param)
    rows = make_records(3)
    return brute_force(rows), keep(spark, tmp_path, rows)


def test_matches_are_exact(case):
    sims, link = case
    for min_sim in (0.01, 0.3, 0.9):
        want = {k: s for k, (_, s) in sims.items() if s is not None and s >= min_sim}
        same(as_dict(linkage.record_matches(link, min_sim)), want)
        assert linkage.group_matches(link, min_sim).agg(F.sum("n_pairs")).first()[0] == len(want)


def test_requested(spark, case):
    sims, link = case
    asked = [(i, j) for i in range(0, 60, 4) for j in range(0, 60, 3)]
    requests = spark.createDataFrame([*asked, asked[0], (999, 1)], "l_id bigint, r_id bigint")
    got = linkage.requested(link, requests)
    same(as_dict(got), {k: sims[k][1] for k in asked})
    assert {(r.l_id, r.r_id): r.n_common for r in got.collect()} == {k: sims[k][0] for k in asked}


def test_index_agrees_with_units(case):
    _, link = case
    units = link.index.hot.unionByName(
        link.index.cold_l.withColumn("src", F.lit("l")).unionByName(link.index.cold_r.withColumn("src", F.lit("r")))
    ).select(link.units.columns)
    assert units.exceptAll(link.units).isEmpty() and link.units.exceptAll(units).isEmpty()


def test_scores_move_no_vectors(spark, tmp_path):
    """Only the pairs go through an exchange: once for either side's records."""
    link = keep(spark, tmp_path, make_records(4), "plans")
    asked = spark.createDataFrame([(i, j) for i in range(9) for j in range(9)], "l_rep bigint, r_rep bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = pairs.indexed_scores(asked, link.index)._jdf.queryExecution().executedPlan().toString()
        tokens = pairs.indexed_candidates(link.index, 0.2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(l_rep", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(r_rep", plan)) == 1
    assert len(re.findall("Exchange", plan)) == 2 and plan.count("Bucketed: true") == 2
    # Rare words are joined where they lie: the first exchange above them is that of the pairs.
    cold = [line for line in tokens.splitlines() if "Bucketed: true" in line]
    assert len(cold) == 2
    first = tokens.splitlines().index(cold[0])
    above = tokens.splitlines()[:first]
    joined = max(i for i, line in enumerate(above) if "SortMergeJoin [token" in line)
    assert not any("Exchange" in line for line in above[joined:])


def test_opened_again_without_work(spark, tmp_path):
    rows = make_records(5)
    first = keep(spark, tmp_path, rows, "again")
    path = f"{tmp_path}/again"

    def never():
        raise AssertionError("built a second time")

    second = linkage.kept_link(spark, "again", [path], never, STOP)
    assert second.units.inputFiles() == first.units.inputFiles()
    # Another session knows no tables, only the folder.
    for table in spark.catalog.listTables(pattern="kept_*"):
        spark.sql(f"DROP TABLE {table.name}")
    third = linkage.kept_link(spark, "again", [path], never, STOP)
    sims = brute_force(rows)
    same(as_dict(linkage.record_matches(third, 0.3)), {k: s for k, (_, s) in sims.items() if s is not None and s >= 0.3})


def test_changed_files_are_linked_anew(spark, tmp_path):
    first = keep(spark, tmp_path, [("l", 1, "a1 b1"), ("r", 1, "a1 b1")], "changes")
    second = keep(spark, tmp_path, [("l", 1, "a1 b1"), ("r", 1, "c1 b1 d1")], "changes")
    assert as_dict(linkage.record_matches(first, 0.01)).keys() == {(1, 1)}
    assert second.units.count() == 5 and first.units.inputFiles() != second.units.inputFiles()


def test_unfinished_tables_are_not_opened(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/kept/part-of-it")
    assert kept.open_kept(spark, f"{tmp_path}/kept") is None
    made = kept.keep(spark, f"{tmp_path}/kept", {"t": spark.range(9).withColumnRenamed("id", "k")}, {"t": kept.Layout("k")})
    assert sorted(r.k for r in kept.open_kept(spark, f"{tmp_path}/kept")["t"].collect()) == sorted(r.k for r in made["t"].collect()) == list(range(9))


def test_kept_outside_of_scopes(spark, tmp_path):
    rows = make_records(6)
    with scope(spark):
        link = keep(spark, tmp_path, rows, "scoped")
    assert link.units.count() > 0 and link.index.vec_l.count() > 0


def test_nothing_to_link(spark, tmp_path):
    link = keep(spark, tmp_path, [("l", 1, ""), ("r", 2, None)], "nothing")
    assert linkage.record_matches(link, 0.5).count() == 0
    asked = spark.createDataFrame([(1, 2)], "l_id bigint, r_id bigint")
    assert [tuple(r) for r in linkage.requested(link, asked).collect()] == [(1, 2, 0, None)]


def test_gold_of_passages_is_kept(spark):
    folder = "/root/testdata/sf0.001"
    assert inputs.passage_gold(spark, folder).inputFiles() == inputs.passage_gold(spark, folder).inputFiles()
