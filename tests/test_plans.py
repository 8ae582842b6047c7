
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in E.queries().items():
        out[name] = fn(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cartesian_products(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]


def test_no_single_partition_shuffles(plans):
    """No un-partitioned window or global aggregate funnels rows into one task."""
    bad = [n for n, p in plans.items() if "SinglePartition" in p]
    assert not bad


def test_at_most_one_python_stage(plans):
    assert all(p.count("ArrowEvalPython") + p.count("BatchEvalPython") <= 1 for p in plans.values())
    assert not [n for n, p in plans.items() if "BatchEvalPython" in p]  # never row-at-a-time


def test_keep_last_prunes_before_the_shuffle(plans):
    for name in ("keep_last_key", "keep_last_url_key", "merge_master", "latest_attempt"):
        assert "WindowGroupLimit" in plans[name], name


def test_column_functions_are_narrow(plans):
    for name in ("canonical_projection", "label_cleanup", "parse_mixed_dates", "keyword_hits",
                 "page_links", "display_dates"):
        assert "Exchange" not in plans[name], name
