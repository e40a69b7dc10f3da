"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from linkloom.oracle import ORACLE
from linkloom.queries import QUERIES
from tests.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(entry_point.queries()[name](spark, FOLDER), con, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["l_id", "r_id", "sim"]


def test_known_numbers(spark):
    """Counts and means that were measured independently on the sf0.01 tables."""
    folder = "/root/testdata/sf0.01"
    run = entry_point.queries()
    assert run["corpus_vocabulary"](spark, folder).count() == 54_130
    model = run["evaluate_model"](spark, folder).first()
    assert (model.n_dup, model.avg_dup, model.avg_nondup) == (26, 0.249637052, 0.000213472)
    histogram = run["similarity_histogram"](spark, folder)
    with_tokens = run["doc_token_counts"](spark, folder).filter("n_kept > 0").count()
    assert histogram.groupBy().sum("n").first()[0] == 40 * with_tokens
    curve = {r.threshold: (r.tp, r.fn, r.fp) for r in run["threshold_curve"](spark, folder).collect()}
    assert (curve[0.1], curve[0.5], curve[0.9]) == ((22, 4, 0), (1, 25, 0), (0, 26, 0))
