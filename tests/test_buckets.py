from __future__ import annotations

from lendstrata.plans import gold
from lendstrata.sources import bucketed
from lendstrata.workload import queries as workload

TINY = "/root/testdata/sf0.001"


def test_buckets_grow_with_the_longest_table(spark, monkeypatch):
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 10)
    assert bucketed.buckets_for([spark.range(5), spark.range(161)], 16) == 32
    assert bucketed.buckets_for([spark.range(0), spark.range(160)], 16) == 16


def test_facts_get_more_buckets_when_they_are_longer(spark, monkeypatch):
    few = {tuple(r) for r in workload.star_bucketed(spark, TINY).collect()}
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 100)
    tables = workload.bucketed_mart(spark, TINY)
    found = bucketed.bucket_rows(tables["fact_loan"], gold.BY_SNAPSHOT, 16).count()
    plan = tables["fact_loan"].groupBy(*gold.BY_SNAPSHOT).count()._jdf.queryExecution().executedPlan().toString()
    assert found and "Exchange" not in plan and "out of 16" not in plan
    many = gold.star_base_bucketed(tables).groupBy("customer_id", "snapshot_date").sum("_copies")
    assert {tuple(r) for r in many.collect()} == few
