"""The plans we want: pruned scans, pushed filters, no row-wise Python, no cartesian products."""

import re

import pytest

import __spark_entry__ as entry
from strataframe.operators.validate import validate_codes
from strataframe.plans import analytics as an
from strataframe.workload import QUERIES
from strataframe.workload import adapters as ad

EAGER = {
    "harmonise_years", "unpivot_months", "context_from_years", "stream_ingest", "csv_roundtrip", "ragged_roundtrip", "partitioned_table", "gold_tables", "model_monthly", "model_granular",
    "coefficient_ranking", "model_consistency", "suppress_complementary",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_rows_and_no_cartesian(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups", plan)


def test_fact_reads_only_its_columns(spark, sf_dir):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(ad.detail_fact(spark, sf_dir)))
    read = {c.split(":")[0] for scan in scans for c in scan.split(",")}
    assert "l_orderkey" in read and "l_extendedprice" not in read and "o_totalprice" not in read and "c_name" not in read


def test_question_prunes_stored_sources(spark, sf_dir):
    plan = plan_of(an.covid_by_country(ad.star(spark, sf_dir), ad.SCOPE))
    assert re.search(r"PartitionFilters: \[[^\]]*fuente", plan)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_incremental_mark_reaches_the_scan(spark, sf_dir):
    assert "GreaterThan(o_orderkey" in plan_of(entry.queries()["incremental_by_id"](spark, sf_dir))


def test_validation_does_not_shuffle_the_rows(spark, sf_dir):
    kept, _ = validate_codes(ad.table(spark, sf_dir, "orders"), "o_custkey", ad.table(spark, sf_dir, "customer"), "c_custkey", critical=True)
    plan = plan_of(kept)
    assert "BroadcastHashJoin [o_custkey" in plan and not re.search(r"Exchange hashpartitioning\(o_custkey", plan)


def test_counting_starts_before_the_shuffle(spark, sf_dir):
    assert "partial_count" in plan_of(ad.detail_fact(spark, sf_dir))
