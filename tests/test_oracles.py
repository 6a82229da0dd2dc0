"""Registered queries against DuckDB on the smallest tables; verify.py does the same at any scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stayline.plans.queries import QUERIES
from verify import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# Queries that fit or read a model while they are built.
FITTED = ("score_agreement", "score_walk", "ledger_checks", "importance_names", "importance_file", "first_splits")
CHECKED = sorted(name for name in oracle_sql() if name in QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_oracle(spark, duck, name):
    assert compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) == []


def test_entry_has_one_row_per_customer(spark):
    assert entry(spark).count() == 150


def test_only_fitted_models_go_without_an_oracle():
    assert set(QUERIES) - set(oracle_sql()) == {"train_gbt", "cv_auc", "score_customers", "feature_importance"}


def test_no_query_plans_a_cross_join(spark):
    # Those that fit or store something run jobs while they are built; their parts are among the others.
    eager = {"seeds_to_feature_store", *FITTED} | set(QUERIES) - set(oracle_sql())
    for name in sorted(set(QUERIES) - eager):
        text = queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
