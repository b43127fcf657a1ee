"""Every registered query at the smallest scale, against its SQL where it has one."""

import pytest

from checks import compare, queries
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"train_trees", "score_with_trees", "score_requests", "trained_inference"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        verdict = compare.compare(df, con, ORACLES[name])
        assert verdict.startswith("ok"), verdict
    else:
        assert df.count() >= 0


@pytest.mark.parametrize("name", ["flatten_events", "collapse_profiles", "collapse_sets", "pair_features", "rule_scores", "candidate_pairs"])
def test_main_path_stays_in_the_jvm_and_has_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "SinglePartition"):
        assert bad not in plan, bad


def test_stored_tables_can_be_forgotten():
    queries.forget()
