"""Every query with SQL gives the same full result as that SQL."""

import pytest
from compare import difference
from conftest import SMALL

import __spark_entry__ as entry
from rowtide.operators.ordered import OrderedGroups

WITH_SQL = sorted(entry.oracle_sql())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, db, name):
    assert difference(entry.queries()[name](spark, SMALL), db, entry.oracle_sql()[name]) is None


# Rows per chunk that cut the groups of each panel: customers have up to 25 orders, suppliers
# some 600 lines, users some 70 events, and whole-table groups are larger still.
ORDER_QUERIES = [
    "last_row",
    "middle_row",
    "feature_row",
    "narrow_feature_row",
    "reverse_position",
    "pivot_positions",
    "drop_old_positions",
    "segments",
    "segments_null_entity",
    "factorize",
    "one_hot",
]
LINE_QUERIES = ["mean_abs_dev", "cat_stats", "feature_row_wide", "feature_row_early", "gauss_rank_fit"]
EVENT_QUERIES = [
    "first_last_lag",
    "diff_p",
    "rank_by_cat",
    "rank_by_cat_many",
    "global_rank",
    "metric_components",
    "metric_by_fold",
    "metric_missing",
    "top_share",
    "stratified_folds",
    "gauss_rank",
    "gauss_rank_edges",
    "gauss_rank_many",
    "gauss_rank_inverse",
]


@pytest.fixture
def cuts(monkeypatch):
    """Whether each ordered group that a query builds was cut."""
    seen = []
    plain = OrderedGroups._cut

    def cut(self):
        plain(self)
        seen.append(self.is_split)

    monkeypatch.setattr(OrderedGroups, "_cut", cut)
    return seen


@pytest.mark.parametrize(
    ("name", "rows"),
    [(n, 5) for n in ORDER_QUERIES] + [(n, 60) for n in LINE_QUERIES] + [(n, 40) for n in EVENT_QUERIES],
)
def test_matches_sql_when_groups_are_split(spark, db, conf, cuts, name, rows):
    conf("spark.rowtide.rowsPerChunk", rows)
    conf("spark.rowtide.broadcastRows", 3)
    got = difference(entry.queries()[name](spark, SMALL), db, entry.oracle_sql()[name])
    assert got is None
    assert any(cuts)


@pytest.mark.parametrize("name", ["standardise_by_cat", "calendar"])
def test_matches_sql_without_broadcasts(spark, db, conf, name):
    conf("spark.rowtide.rowsPerChunk", 40)
    conf("spark.rowtide.broadcastRows", 3)
    assert difference(entry.queries()[name](spark, SMALL), db, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "o_custkey"
