from __future__ import annotations

from pathlib import Path

from lendstrata.sources import inference
from lendstrata.workload import queries as workload


def _types(spark, path, **options):
    return {r.column_name: (r.data_type, r.date_format, r.n_values, r.n_nulls) for r in inference.column_types(spark, path, **options).collect()}


def test_tests_of_values_do_not_multiply_with_the_columns(spark, folder):
    names = [f"c{i}" for i in range(40)]
    Path(f"{folder}/x.csv").write_text("\n".join([",".join(names), ",".join(["1.5"] * 40)]))
    found = inference.column_types(spark, f"{folder}/x.csv")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") < 20
    assert [r.data_type for r in found.orderBy("position").collect()] == ["double"] * 40


def test_values_that_look_like_dates_or_numbers(spark, folder):
    rows = [
        "day,us,both,like,whole,big,part,text,flag,none",
        "2024-01-31,1/31/24,20240131,123-45-6789,-7,7,1e5,1/2,true,",
        "1999-12-01,12/1/99,20231201,2024-01-31,0,9999999999,-3,x,FALSE, ",
    ]
    Path(f"{folder}/x.csv").write_text("\n".join(rows))
    found = _types(spark, f"{folder}/x.csv", date_formats=("yyyyMMdd", "yyyy-MM-dd", "M/d/yy"))
    assert {c: t[:2] for c, t in found.items()} == {
        "day": ("date", "yyyy-MM-dd"), "us": ("date", "M/d/yy"), "both": ("int", None), "like": ("string", None),
        "whole": ("int", None), "big": ("bigint", None), "part": ("double", None), "text": ("string", None),
        "flag": ("boolean", None), "none": ("void", None),
    }
    assert found["none"][2:] == (0, 2) and found["day"][2:] == (2, 0)


def test_formats_with_month_names_or_quotes(spark, folder):
    Path(f"{folder}/x.csv").write_text("a,b\n31 Jan 2024,2024T0131\n1 Feb 2024,1999T1201\n")
    found = _types(spark, f"{folder}/x.csv", date_formats=("d MMM yyyy", "yyyy'T'MMdd"))
    assert [t[1] for t in found.values()] == ["d MMM yyyy", "yyyy'T'MMdd"]


def test_a_csv_without_rows_has_columns_without_values(spark, folder):
    Path(f"{folder}/x.csv").write_text("a,b\n")
    assert _types(spark, f"{folder}/x.csv") == {"a": ("void", None, 0, 0), "b": ("void", None, 0, 0)}


def test_sources_are_not_written_by_three_tasks(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(workload, "write_raw_csv", lambda raw, path, spec: written.update({spec.name: raw}))
    monkeypatch.setattr(workload.inference, "column_types", lambda spark, path: spark.createDataFrame([], "position int, column_name string, data_type string, date_format string, n_values long, n_nulls long"))
    workload.inferred_contract(spark, "/root/testdata/sf0.001")
    plans = [raw._jdf.queryExecution().logical().toString() for raw in written.values()]
    assert len(plans) == 3 and not any("Repartition 3" in plan for plan in plans)
