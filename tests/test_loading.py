from __future__ import annotations

from pathlib import Path

import pytest

from lendstrata import session
from lendstrata.plans import increments, medallion
from lendstrata.plans.cleaners import SOURCES
from lendstrata.sources import files
from lendstrata.sources.specs import SNAPSHOT
from lendstrata.workload import inputs, queries as workload

SPEC = SOURCES["features_attributes"]


@pytest.fixture
def delivered(spark, folder):
    raw = inputs.raw_attributes(spark, "/root/testdata/sf0.001")
    workload.write_raw_csv(raw, f"{folder}/x.csv", SPEC)
    dates = sorted({workload._as_read(r[0]) for r in raw.select(SNAPSHOT).distinct().collect()})
    return f"{folder}/x.csv", dates


def test_deliveries_are_zipped_in_bounded_files(spark, folder, delivered, monkeypatch):
    assert all(p.name.endswith(".csv.gz") for p in Path(delivered[0]).glob("part-*"))
    monkeypatch.setattr(workload, "ROWS_PER_CSV", 100)
    raw = inputs.raw_attributes(spark, "/root/testdata/sf0.001")
    workload.write_raw_csv(raw, f"{folder}/y.csv", SPEC)
    assert len([*Path(f"{folder}/y.csv").glob("part-*")]) >= raw.count() / 100


def test_a_large_delivery_reaches_bronze_without_a_shuffle(spark, folder, delivered, monkeypatch):
    path, dates = delivered
    assert files.tasks_for(spark, path, len(dates)) is None  # a small one is shuffled into few files
    medallion.load_bronze(spark, path, f"{folder}/shuffled", SPEC, dates)
    monkeypatch.setattr(files, "LEAST_SHARE", 1)
    tasks = files.tasks_for(spark, path, len(dates))
    assert tasks == spark.sparkContext.defaultParallelism
    arranged = []
    monkeypatch.setattr(files, "_arranged", lambda df, by, clustered, was=files._arranged: arranged.append(clustered) or was(df, by, clustered))
    medallion.load_bronze(spark, path, f"{folder}/bronze", SPEC, dates)
    assert arranged == [True]
    both = [files.read_table(spark, f"{folder}/{name}", SPEC.raw) for name in ("shuffled", "bronze")]
    assert both[0].count() > 0 and both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()
    assert all(len([*p.glob("*.parquet")]) <= tasks for p in Path(f"{folder}/bronze").glob(f"*/{SNAPSHOT}=*"))


@pytest.mark.parametrize("step", ["run", "advance"])
def test_runs_write_without_sorting_and_leave_the_session_as_it_was(spark, monkeypatch, step):
    seen = []
    module, name = (medallion, "_run") if step == "run" else (increments, "_advance")
    monkeypatch.setattr(module, name, lambda spark, *_: seen.append({k: spark.conf.get(k) for k in session.LOADING}))
    before = {k: spark.conf.get(k, None) for k in session.LOADING}
    getattr(module, step)(spark, medallion.RunConfig(medallion.Layout("raw", "lake")))
    assert seen == [session.LOADING] and {k: spark.conf.get(k, None) for k in session.LOADING} == before


def test_settings_of_the_session_stay_in_force(spark):
    key = "spark.sql.parquet.compression.codec"
    spark.conf.set(key, "gzip")
    try:
        with session.loading(spark):
            assert spark.conf.get(key) == "gzip"
        assert spark.conf.get(key) == "gzip"
    finally:
        spark.conf.unset(key)
