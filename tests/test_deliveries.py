"""CSV deliveries that do not keep their contract, contracts found in files, attributes over time."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F

from lendstrata.operators import history
from lendstrata.operators.contracts import ContractError
from lendstrata.plans import medallion
from lendstrata.plans.cleaners import SOURCES
from lendstrata.sources import files, inference, published, rejects
from lendstrata.sources.specs import RAW_LOANS, SNAPSHOT

LOANS = SOURCES["lms_loan_daily"]
HEADER = "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"
GOOD = "L{0},C{0},2023-01-01,10,{0},1000,100.5,0,0,900,2023-0{1}-01"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def csv(folder: str, *lines: str, name: str = "x.csv", header: str = HEADER) -> str:
    Path(folder, name).write_text("\n".join([header, *lines]) + "\n")
    return f"{folder}/{name}"


FAULTY = {
    "L8,C8,2023-01-01,10,1,1000,1,0,0,900": ["number of fields"],
    "L9,C9,2023-01-01,10,1,1000,1,0,0,900,2023-01-01,more": ["number of fields"],
    "L7,C7,2023-01-01,ten,1,1000,1,0,x,900,2023-01-01": ["tenure is no int: ten", "overdue_amt is no double: x"],
    "L6,C6,yesterday,10,1,1000,1,0,0,900,2023-01-01": ["loan_start_date is no date: yesterday"],
    "L5,C5,2023-01-01,10,1,1000,1,0,0,900,2023-02-31": ["snapshot_date is no date: 2023-02-31"],
    "L4,C4,2023-01-01,10,1,1000,1,0,0,900,": ["no snapshot_date"],
    "L3,C3,2023-01-01,10,1,99999999999,1,0,0,900,2023-01-01": ["loan_amt is no int: 99999999999"],
}


def test_faulty_lines_are_set_aside(spark, folder):
    good = [GOOD.format(n, m) for n in range(1, 4) for m in (1, 2)] + ["L1,C1,,,,,,,,,2023-02-01"]
    path = csv(folder, *good[:3], *FAULTY, *good[3:])
    lines = rejects.sorted_lines(spark, path, LOANS, counts := Observation("test"))
    aside = {r.line: r.faults for r in rejects.rejected(lines).collect()}
    assert {line.rstrip(","): found for line, found in aside.items()} == {line.rstrip(","): found for line, found in FAULTY.items()}
    accepted = rejects.accepted(lines, LOANS)
    assert accepted.schema.names == RAW_LOANS.names
    csv(folder, *good, name="good.csv")
    want = files.read_snapshots(spark, f"{folder}/good.csv", LOANS)
    at = [c for c in want.columns if c != "_metadata_file_name"]
    assert rows(accepted.select(at)) == rows(want.select(at))
    lines.write.format("noop").mode("overwrite").save()
    assert counts.get == {"lines": len(good) + len(FAULTY), "rejected": len(FAULTY)}
    assert {Path(r.file).name for r in rejects.rejected(lines).collect()} == {"x.csv"}


def test_a_load_with_rejects(spark, folder):
    path = csv(folder, GOOD.format(1, 1), GOOD.format(2, 2), *list(FAULTY)[:2])
    days = [date(2023, 1, 1), date(2023, 2, 1)]
    to = (f"{folder}/bronze", LOANS, days, f"{folder}/rejects")
    with pytest.raises(rejects.TooManyRejects, match="2 of 4"):
        medallion.load_bronze(spark, path, *to, most_rejects=0.4)
    assert not files.table_exists(spark, f"{folder}/bronze") and published.read(spark, f"{folder}/rejects").count() == 2
    assert medallion.load_bronze(spark, path, *to, most_rejects=0.5) == {"lines": 4, "rejected": 2}
    assert medallion.read_bronze(spark, f"{folder}/bronze", LOANS).count() == 2
    path = csv(folder, GOOD.format(1, 1), name="y.csv")
    assert medallion.load_bronze(spark, path, *to) == {"lines": 1, "rejected": 0}
    assert published.read(spark, f"{folder}/rejects").count() == 0
    assert [r[0] for r in files.stored_snapshots(spark, f"{folder}/bronze").collect()] == days[:1]


def test_a_run_sets_lines_aside(spark, folder):
    Path(folder, "raw").mkdir()
    csv(f"{folder}/raw", GOOD.format(1, 1), *list(FAULTY)[:1], name="lms_loan_daily.csv")
    layout = medallion.Layout(f"{folder}/raw", f"{folder}/lake")
    for most, stored in ((None, False), (0.2, False), (0.6, True)):
        with pytest.raises(medallion.RunFailed) as e:  # the other sources are missing
            medallion.run(spark, medallion.RunConfig(layout, date(2023, 1, 1), date(2023, 3, 1), most_rejects=most))
        assert ("lms_loan_daily" in e.value.failures) != stored
        assert files.table_exists(spark, layout.bronze("lms_loan_daily")) == stored


def test_a_missing_column_is_a_broken_contract(spark, folder):
    path = csv(folder, "L1,2023-01-01", header="loan_id,snapshot_date")
    for read in (files.read_snapshots, rejects.sorted_lines):
        with pytest.raises(ContractError, match="missing columns.*Customer_ID"):
            read(spark, path, LOANS)
    with pytest.raises(ContractError, match="Shoe"):
        rejects.sorted_lines(spark, csv(folder, "1", header="Shoe"), LOANS)


# contracts found in files

VALUES = {
    "whole": (["1", "-20", "0"], "int", None),
    "long": (["1", "3000000000"], "bigint", None),
    "real": (["1", "2.5", "-1e-3"], "double", None),
    "code": (["007", "12"], "string", None),
    "iso": (["2023-01-31", "2024-02-29"], "date", "yyyy-MM-dd"),
    "us": (["1/31/23", "12/1/99"], "date", "M/d/yy"),
    "mixed": (["2023-01-31", "1/31/23"], "string", None),
    "noday": (["2023-02-31", "2023-01-01"], "string", None),
    "flag": (["true", "FALSE"], "boolean", None),
    "text": (["1", "one"], "string", None),
    "none": ([], "void", None),
}


@pytest.mark.parametrize("seed", range(3))
def test_types_do_not_depend_on_files(spark, folder, seed):
    draw = random.Random(seed)
    columns = {c: [*v * 4, *[""] * (12 - 4 * len(v)), *[" "] * 3] for c, (v, *_) in VALUES.items()}
    for v in columns.values():
        draw.shuffle(v)
    n = max(map(len, columns.values()))
    lines = [",".join((v + [""] * n)[i] for v in columns.values()) for i in range(n)]
    Path(folder, "x.csv").mkdir()
    cuts = sorted(draw.sample(range(n), 3))
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, n])):
        csv(f"{folder}/x.csv", *lines[a:b], name=f"{draw.random()}.csv", header=",".join(columns))
    found = inference.column_types(spark, f"{folder}/x.csv")
    assert {r.column_name: (r.data_type, r.date_format) for r in found.collect()} == {c: (t, f) for c, (_, t, f) in VALUES.items()}
    assert {r.column_name: r.n_values for r in found.collect()} == {c: 4 * len(v) for c, (v, *_) in VALUES.items()}
    contract, formats = inference.as_contract(found)
    assert contract.names == list(VALUES) and contract["none"].dataType.simpleString() == "string"
    assert formats == {"iso": "yyyy-MM-dd", "us": "M/d/yy"}
    assert inference.column_types(spark, f"{folder}/x.csv", by_file=True).select("_file").distinct().count() <= 4


# attributes over time


def plain_intervals(data):
    by_key = {}
    for key, day, a, b in data:
        state = (a, b)
        old = by_key.setdefault(key, {}).get(day, state)
        by_key[key][day] = min(old, state, key=lambda s: [(v is not None, v or 0) for v in s])
    out = []
    for key, days in by_key.items():
        starts = []
        for day in sorted(days):
            if not starts or starts[-1][1] != days[day]:
                starts.append((day, days[day]))
        ends = [day for day, _ in starts[1:]] + [None]
        out += [(key, *state, day, end) for (day, state), end in zip(starts, ends)]
    return Counter(out)


def invented(seed):
    draw = random.Random(seed)
    return [
        (draw.choice(["a", "b", "c", None]), date(2023, draw.randrange(1, 13), 1), draw.choice([1, 2, None]), draw.choice([7, None]))
        for _ in range(60)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_intervals_and_lookups(spark, seed):
    data = invented(seed)
    df = spark.createDataFrame(data, "k string, d date, a int, b int").repartition(4)
    found = history.validity_intervals(df, "k", "d", ["a", "b"])
    assert rows(found) == plain_intervals(data)
    draw = random.Random(seed + 100)
    asked = [(n, draw.choice(["a", "b", "z"]), date(draw.choice([2022, 2023, 2024]), draw.randrange(1, 13), 15)) for n in range(200)]
    facts = spark.createDataFrame(asked, "n int, k string, d date")
    stays = [r for r in plain_intervals(data).elements() if r[0] is not None]

    def held(key, day):
        hits = [r for r in stays if r[0] == key and r[3] <= day and (r[4] is None or day < r[4])]
        return hits[0][1:4] if hits else None

    want = {n: held(k, d) for n, k, d in asked}
    inner = history.as_of(facts, found, "k", "d", ["a", "b"])
    assert {r.n: (r.a, r.b, r.valid_from) for r in inner.collect()} == {n: w for n, w in want.items() if w}
    outer = history.as_of(facts, found, "k", "d", ["a", "b"], how="left")
    assert outer.count() == 200 and {r.n for r in outer.where("valid_from is null").collect()} == {n for n, w in want.items() if not w}


def test_a_hot_customer_is_looked_up_evenly(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(date(2023, 5, 1)).alias("d"), "id",
    )
    held = spark.createDataFrame([("hot", 1, date(2023, 1, 1), None)], "k string, a int, valid_from date, valid_to date")
    got = history.as_of(facts, held, "k", "d", ["a"], how="left")
    assert got.count() == 3000 and got.where("a = 1").count() == 2000
    assert "_salt" in got._jdf.queryExecution().analyzed().toString()
