from __future__ import annotations

import threading
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from lendstrata.plans.cleaners import SOURCES
from lendstrata.sources import files
from lendstrata.workload import inputs, queries as workload

TINY = "/root/testdata/sf0.001"


def test_orders_are_dealt_out_before_they_become_text(spark):
    plan = inputs.raw_financials(spark, TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert plan.index("Annual_Income") < plan.index("RebalancePartitions")  # the text is made above the exchange


def test_sources_are_delivered_side_by_side(spark, folder, monkeypatch):
    together = threading.Barrier(2, timeout=30)
    monkeypatch.setattr(workload, "write_raw_csv", lambda raw, path, spec: together.wait())
    names = ["features_attributes", "lms_loan_daily"]
    assert set(names) <= set(SOURCES)
    workload.write_side_by_side(spark, dict.fromkeys(names), folder)


def test_spans_are_seen_while_sources_are_written(spark, monkeypatch):
    """No source is derived a second time for its first and last snapshot."""
    seen, write = {}, workload.write_side_by_side

    def noted(spark, sources, folder):
        seen.update({name: df._jdf.queryExecution().optimizedPlan().toString() for name, df in sources.items()})
        write(spark, sources, folder)

    monkeypatch.setattr(workload, "write_side_by_side", noted)
    _, low, high, earlier = workload._delivered(spark, TINY)
    assert len(seen) == 4 and all("CollectMetrics" in plan for plan in seen.values())
    later = F.add_months("snapshot_date", workload.MONTHS_LATER)
    frames = [raw(spark, TINY).select(later.alias("d")) for raw in (inputs.raw_loans, inputs.raw_financials, inputs.raw_attributes)]
    frames.append(inputs.raw_clickstream(spark, TINY, inputs.CLICK_MONTH).select(F.col("snapshot_date").alias("d")))
    ends = [df.agg(F.min("d"), F.max("d"), F.add_months(F.max("d"), -3)).first() for df in frames]
    assert (low, high, earlier) == (min(e[0] for e in ends), max(e[1] for e in ends), min(e[2] for e in ends))


def test_snapshot_dates_are_parsed_once(spark, folder):
    """Not again by the filter on them."""
    spec = SOURCES["features_attributes"]
    lines = ["Customer_ID,Name,Age,SSN,Occupation,snapshot_date", *(f"C{m},N,1,S,O,2023-0{m}-01" for m in (1, 2, 3)), "C4,N,1,S,O,soon"]
    path = Path(folder, "x.csv")
    path.write_text("\n".join(lines) + "\n")
    read = files.read_snapshots(spark, str(path), spec, [date(2023, 2, 1), date(2023, 3, 1)])
    assert sorted(r.Customer_ID for r in read.collect()) == ["C2", "C3"]
    assert all(r._metadata_file_name.endswith("x.csv") and r.date == r.snapshot_date for r in read.collect())
    assert read._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp") == 1
