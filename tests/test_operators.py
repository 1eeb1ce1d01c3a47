from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendstrata.operators import cleaning, contracts, features, incremental, profile, quantiles, reshape, skew


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# contracts


def test_schema_differences(spark):
    wanted = StructType.fromDDL("a int, b string")
    assert contracts.schema_differences(wanted, wanted) == []
    assert contracts.schema_differences(StructType.fromDDL("a int not null, b string"), wanted) == []
    assert contracts.schema_differences(StructType.fromDDL("b string, a int"), wanted)
    got = contracts.schema_differences(StructType.fromDDL("a bigint, c string"), wanted)
    assert got == ["a is bigint, expected int", "missing column b", "unexpected column c"]


def test_assert_schema(spark):
    df = spark.range(1)
    assert contracts.assert_schema(df, df.schema) is df
    with pytest.raises(contracts.ContractError, match="loans: missing column x"):
        contracts.assert_schema(df, StructType.fromDDL("id bigint, x int"), "loans")


def test_same_columns(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1)
    contracts.assert_same_columns(a, b, ignore=["x"])
    with pytest.raises(contracts.ContractError):
        contracts.assert_same_columns(a, b)


# cleaning


def test_numeric_columns_skip_text(spark):
    df = spark.createDataFrame([(1.0e7, "1_5")], "x double, y string")
    got = cleaning.cast_columns(df, floats=["x"], ints=["y"])
    assert got.collect() == [(1.0e7, 15)]
    assert "translate(x" not in got._jdf.queryExecution().toString()


def test_multi_hot(spark):
    lists = ["Auto Loan, Payday Loan, and Auto Loan", "A and B", "", "Not Specified", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, loans string")
    got = cleaning.multi_hot(df, "loans", ["Auto Loan", "Payday Loan"]).orderBy("i")
    assert got.columns == ["i", "Has_Auto_Loan", "Has_Payday_Loan"]
    assert [tuple(r)[1:] for r in got.collect()] == [(1, 1), (0, 0), (0, 0), (0, 0), (None, None)]


def test_complete_cases(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (None, 2.0)], "a int, b double")
    assert cleaning.complete_cases(df).collect() == [(2, 1.0)]


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([("k", 1, None)], "key string, `a-1` int, b int")
    got = reshape.unpivot(df, ["key"], ["a-1", "b"], "name", "value")
    assert rows(got) == Counter([("k", "a-1", 1), ("k", "b", None)])


# incremental


def pairs(spark, values):
    return spark.createDataFrame(values, "a int, b string")


def test_common_and_new_rows(spark):
    incoming = pairs(spark, [(1, "x"), (1, "x"), (2, None), (3, "z"), (3, "z")])
    stored = pairs(spark, [(1, "x"), (2, None), (9, "q")])
    assert rows(incremental.common_rows(incoming, stored)) == Counter([(1, "x"), (2, None)])
    assert rows(incremental.new_rows(incoming, stored)) == Counter({(3, "z"): 2})
    assert incremental.load_state(incoming, stored).collect() == [(3, 2, False)]
    assert incremental.load_state(incoming, incoming).first().already_loaded


def test_digest_tells_apart_what_text_confuses(spark):
    df = spark.createDataFrame([("a_b", None), ("a", "b"), (None, "a_b")], "x string, y string")
    got = df.select(incremental.row_text(["x", "y"]).alias("t"), incremental.row_digest(["x", "y"]).alias("d"))
    assert got.select("t").distinct().count() == 1
    assert got.select("d").distinct().count() == 3


def test_missing_snapshots(spark):
    wanted = spark.sql("select explode(sequence(date'2023-01-01', date'2023-03-01', interval 1 month)) snapshot_date")
    stored = wanted.filter("month(snapshot_date) <> 2")
    assert [str(r[0]) for r in incremental.missing_snapshots(wanted, stored).collect()] == ["2023-02-01"]


# skew


def skewed(spark):
    """A third of the rows, all of them equal, hold one key; another key is unknown to the right."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, -1).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )


def few_each(spark):
    """Less than a hundredth of the rows for any key, and the key in another integer type."""
    return spark.range(800).select((F.col("id") % 400).cast("int").alias("k"), F.col("id").alias("w"))


def lopsided(spark):
    """A third of the rows hold a key that is rare on the skewed side."""
    rare = F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("id") % 300)
    return spark.range(900).select(rare.cast("int").alias("k"), F.col("id").alias("w"))


def partition_sizes(df):
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    return [r.n for r in sizes]


@pytest.fixture
def shuffled_joins(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in off.items():
        spark.conf.set(key, value)
    yield
    for key in off:
        spark.conf.unset(key)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("other", [few_each, lopsided, skewed])
@pytest.mark.parametrize("salted", [True, False])
def test_skew_join_equals_join(spark, how, other, salted):
    left, right = skewed(spark), other(spark).withColumnRenamed("v", "w")
    number = skew.with_row_salt if salted else lambda df: df
    got = skew.skew_join(number(left), number(right), ["k"], how).select("k", "v", "w")
    want = left.join(right, "k", how).select("k", "v", "w")
    summary = [F.count("*"), F.sum(F.xxhash64("k", "v", "w").cast("decimal(38,0)"))]
    assert got.agg(*summary).collect() == want.agg(*summary).collect()
    assert "_salt" in got._jdf.queryExecution().toString()


def test_hot_left_key_is_found_and_spread(spark, shuffled_joins):
    left = skewed(spark)
    (hot,) = skew.hot_keys(left, ["k"])
    ids = {r.k: r.h for r in left.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert hot[ids[7]] > 0.33 and hot[ids[-1]] > 0.33
    joined = skew.skew_join(skew.with_row_salt(left), few_each(spark), ["k"])
    sizes = partition_sizes(joined.filter("k = 7"))
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 2


def test_hot_right_key_is_spread(spark, shuffled_joins):
    joined = skew.skew_join(few_each(spark), lopsided(spark).withColumnRenamed("w", "v"), ["k"])
    sizes = partition_sizes(joined.filter("k = 8"))
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 2


def test_buckets_grow_with_the_share_and_the_cluster(spark):
    df = spark.range(1)
    assert skew._by_buckets(df, {1: 0.33, 2: 0.01}) == {16: [1], 2: [2]}
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    assert skew._by_buckets(df, {1: 0.33, 2: 0.01}) == {32768: [1], 1024: [2]}
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_smaller_keys_are_hot_on_larger_clusters(spark):
    df = few_each(spark)
    assert skew.hot_keys(df, ["k"]) == [{}]
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    (hot,) = skew.hot_keys(df, ["k"])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(hot) == 400 and set(hot.values()) == {1 / 400}


def test_key_hot_on_both_sides_is_spread_over_a_grid(spark, shuffled_joins):
    left, right = skewed(spark).withColumn("v", F.monotonically_increasing_id()), lopsided(spark)
    right = right.withColumn("k", F.when(F.col("k") == 8, 7).otherwise(F.col("k")))
    hot_left, hot_right = skew.hot_keys(left, ["k"])[0], skew.hot_keys(right, ["k"])[0]
    buckets = max(skew._by_buckets(left, hot_left))
    joined = skew.skew_join(left, right, ["k"])
    sizes = partition_sizes(joined.filter("k = 7"))
    assert sum(sizes) == left.filter("k = 7").count() * right.filter("k = 7").count()
    assert len(sizes) >= 5 and max(sizes) <= sum(sizes) / 2
    assert hot_right and buckets == 16
    # either side is copied along one line of the grid
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2


def test_no_hot_keys_plain_plan(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    assert skew.hot_keys(left, ["k"]) == [{}]
    assert "_salt" not in skew.skew_join(left, left, ["k"])._jdf.queryExecution().toString()


def test_hot_keys_of_nothing(spark):
    assert skew.hot_keys(spark.range(0), ["id"], ["id"]) == [{}, {}]


def test_replicate_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 10)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10), ("d", 95), ("e", None), ("f", -1)], "x string, n int")
    want = Counter({("b",): 1, ("c",): 10, ("d",): 95})
    assert rows(skew.replicate_rows(df, "n")) == want
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 100)
    assert rows(skew.replicate_rows(df, "n", 95)) == want


# quantiles


def expected_quantile(values, p):
    ordered = sorted(values)
    return ordered[max(1, int(np.ceil(p * len(ordered)))) - 1]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(allow_nan=False, allow_infinity=True), st.integers(-5, 5).map(float), st.just(-0.0)
        ),
        min_size=1,
        max_size=40,
    ),
    st.integers(1, 3),
)
def test_exact_quantiles(spark, values, copies):
    df = spark.createDataFrame([(v, copies) for v in values] + [(float("nan"), 1), (None, 1)], "x double, n int")
    got = quantiles.quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0], 0, weight="n").first().x
    assert got == [expected_quantile(values * copies, p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]


def test_approximate_quantiles_stay_within_their_error(spark):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).cast("double").alias("x"), F.lit(2).alias("n"))
    for weight in (None, "n"):
        (q1, q3) = quantiles.quantiles(df, ["x"], [0.25, 0.75], 0.01, weight).first().x
        assert abs(q1 - 5_000) <= 200 and abs(q3 - 15_000) <= 200


def test_iqr_filter(spark):
    values = [(float(v), None) for v in range(1, 101)] + [(1000.0, None), (float("nan"), None), (None, None)]
    df = spark.createDataFrame(values, "x double, empty double")
    for error in (0, 0.01):
        kept = quantiles.iqr_filter(df, ["x", "empty", "absent"], relative_error=error)
        assert sorted(r.x for r in kept.collect()) == [float(v) for v in range(1, 101)]
    assert quantiles.iqr_filter(df, ["absent"]) is df


def test_iqr_fences_are_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in (0, 4, 5, 6, 7, 8, 12, 13)], "x int")
    fences = quantiles.iqr_bounds(df, ["x"], k=1.0, relative_error=0).first().x
    assert (fences.lower, fences.upper) == (0.0, 12.0)
    kept = quantiles.iqr_filter(df, ["x"], k=1.0, relative_error=0)
    assert sorted(r.x for r in kept.collect()) == [0, 4, 5, 6, 7, 8, 12]


def test_exact_quantiles_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(((F.col("id") * 31) % 977).alias("x"))
    got = {
        tuple(quantiles.quantiles(df.repartition(n), ["x"], [0.25, 0.75], 0).first().x) for n in (1, 4, 16)
    }
    assert len(got) == 1


def test_fences_reach_the_scan(spark, folder):
    spark.range(100).select(F.col("id").cast("double").alias("x")).write.parquet(f"{folder}/t")
    kept = quantiles.iqr_filter(spark.read.parquet(f"{folder}/t"), ["x"])
    plan = kept._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(x" in plan and "LessThanOrEqual(x" in plan


# features


def test_log_features(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (0.0, 7.0)], "a double, b double")
    wanted = [features.logarithm("a"), features.logarithm("absent"), features.logarithm("b", features.least_value(df, "b"))]
    got = features.derive(df, wanted).orderBy("a").collect()
    assert [r.a_Log for r in got] == [None, 0.0]
    assert [round(r.b_Log, 6) for r in got] == [round(np.log1p(1), 6), round(np.log1p(3), 6)]


def test_ratios_skip_incomplete_definitions(spark):
    df = spark.createDataFrame([(5.0, 2.0)], "a double, b double")
    got = features.derive(df, [features.ratio("r", "a", "b"), features.ratio("s", "a", "absent")])
    assert features.derive(df, [features.ratio("s", "a", "absent")]).columns == df.columns
    assert got.columns == ["a", "b", "r"] and got.first().r == 2.5


@pytest.mark.parametrize("values", [
    "1e6 + id / 200",  # one cell of the histogram
    "pow(2.0, -(id % 1000))",
    "CASE WHEN id % 3 = 0 THEN double('-infinity') WHEN id % 3 = 1 THEN double('infinity') ELSE id END",
    "CASE WHEN id % 2 = 0 THEN 0.0 ELSE 4.9e-324 END",
    "CASE WHEN id % 4 = 0 THEN 1.7e308 ELSE -1.7e308 END",
])
def test_quantiles_of_close_and_extreme_values(spark, values):
    df = spark.range(20_000).selectExpr(f"double({values}) AS x")
    ordered = sorted(r.x for r in df.collect())
    wanted = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.quantiles(df, ["x"], wanted, 0).first().x
    assert got == [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in wanted]


# profiles


def test_profiles_of_parts_merge_into_that_of_the_whole(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("few"), (F.col("id") % 3000).alias("many"),
        F.lit(None).cast("int").alias("none"), (F.col("id") % 3).alias("snapshot_date"), F.lit(0).alias("all"),
    )
    columns = ["few", "many", "none"]
    parts = {r.column_name: r for r in profile.merged(profile.profiles(df, columns)).select("*", F.hll_sketch_estimate("distinct").alias("n")).collect()}
    whole = profile.profiles(df, columns, by="all").select("*", F.hll_sketch_estimate("distinct").alias("n"), profile.frequent_values().alias("top"))
    for r in whole.collect():
        assert (r.row_count, r.n_nulls) == (parts[r.column_name].row_count, parts[r.column_name].n_nulls)
        assert abs(r.n - {"few": 7, "many": 3000, "none": 0}[r.column_name]) <= 150
        assert abs(parts[r.column_name].n - r.n) <= 150
        if r.column_name == "few":
            assert sum(v["count"] for v in r.top) == 6750 and len(r.top) == 7
        if r.column_name == "none":
            assert r.top == [] and r.n_nulls == 9000


def test_drift_of_shares(spark):
    data = [(1, "a")] * 3 + [(1, "b")] + [(2, "a")] * 2 + [(2, None)] * 2 + [(3, "c")] * 5 + [(4, None)]
    kept = profile.profiles(spark.createDataFrame(data, "snapshot_date int, v string"), ["v"])
    got = {r.snapshot_date: r for r in profile.drift(kept).collect()}
    assert [got[n].value_shift for n in (1, 2, 3)] == [None, 0.25, 1.0]
    assert [got[n].null_share for n in (1, 2, 3, 4)] == [0.0, 0.5, 0.0, 1.0]
    assert [got[n].fresh_share for n in (1, 2, 3, 4)] == [None, 0.0, 1.0, None]
    assert got[4].value_shift == 0.5 and got[2].n_distinct_before == 2
