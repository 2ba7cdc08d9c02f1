"""The registered queries against their SQL, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry
from lorebase.llm.queries import ORACLES, QUERIES
from tests.compare_sql import difference, duck

BY_BRUTE_FORCE = {
    "op2_best_fit_packing", "op4_decontamination", "op5_personal_data", "op6_language_id", "op7_simhash", "op8_lm_score", "op9_quality",
    "op12_spelling_variants", "op13_near_duplicates",
}


def test_all_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == BY_BRUTE_FORCE
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, data, name):
    assert difference(spark, data, name, QUERIES[name], ORACLES[name], duck(data)) is None


@pytest.mark.parametrize("name", ["op1_url_filter", "op3_nearest_vectors", "op7_simhash", "op10_line_dedup"])
def test_no_pairwise_plan(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["op4_decontamination", "op5_personal_data"])
def test_native(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
