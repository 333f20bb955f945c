"""Every query against its SQL on the smallest tables; those without SQL must run."""

from pathlib import Path

import pytest

from compare import connect, difference
from millrace.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_same_as_sql(spark, con, name):
    assert difference(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["store_report_json", "profile_3d_json", "c45_tree", "stem_counts", "cjk_bigrams", "log_rank", "kmeans_clusters", "knn_predictions"])
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    d = registry.queries()["predicate_mix"](spark, SF)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "p_retailprice" not in plan


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_the_core_knows_nothing_of_llm():
    for p in Path(__file__).resolve().parents[1].joinpath("millrace").rglob("*.py"):
        if "llm" not in p.parts:
            assert "millrace.llm" not in p.read_text(), p
