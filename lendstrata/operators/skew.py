"""Joins and row copies that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

HOT_FACTOR = 4  # a key is hot when it would fill this many fair partitions, but
HOT_SHARE_RANGE = (0.001, 0.01)  # always above the larger of these shares, never below the smaller
BUCKETS_PER_PARTITION = 4  # a hot key gets four times its fair share of partitions as buckets
ROW_SALT = "_row_salt"
COPIES_PER_CHUNK = 65_536

HotKeys = Mapping[int, float]  # hash of a key to its share of the rows


def with_row_salt(df: DataFrame) -> DataFrame:
    """Number the rows of a table scan, for ``skew_join`` to salt with.

    To be applied to a scan directly: the rows of a file split keep their order, so a
    task that is run again numbers them alike and identical copies still get different
    numbers. After a shuffle that would not hold.
    """
    return df.withColumn(ROW_SALT, F.monotonically_increasing_id())


def _key_id(df: DataFrame, on: Sequence[str], like: DataFrame) -> Column:
    return F.xxhash64(*(F.col(c).cast(like.schema[c].dataType) for c in on))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _hot_share(df: DataFrame) -> float:
    """Share of the rows from which a key is hot; smaller where there are more partitions."""
    least, most = HOT_SHARE_RANGE
    return min(most, max(least, HOT_FACTOR / _partitions(df)))


def hot_keys(df: DataFrame, *key_sets: Sequence[str]) -> list[HotKeys]:
    """Hot keys with their share of the rows, per key set, from one scan of the key columns.

    Each task keeps a frequent-items sketch per key set and nothing else is shuffled. At
    most a thousand keys can be hot, so the answer is short. The sketch has four counters
    for each possible hot key, and a wrong estimate could only change the balance of a
    join, never its result.
    """
    share = _hot_share(df)
    k, tracked = ceil(1 / share), 2 ** ceil(log2(4 / share))
    top = [
        F.call_function("approx_top_k", _key_id(df, on, df), F.lit(k), F.lit(tracked)).alias(f"top{i}")
        for i, on in enumerate(key_sets)
    ]
    total, *tops = df.agg(F.count(F.lit(1)), *top).first()
    return [{t["item"]: t["count"] / total for t in items if t["count"] >= total * share} for items in tops]


def _by_buckets(df: DataFrame, hot: HotKeys) -> dict[int, list[int]]:
    """Hot keys by the number of buckets they get, a power of two that grows with the
    key's share of the rows and with the shuffle partitions of the session."""
    partitions = _partitions(df)
    groups: dict[int, list[int]] = {}
    for key, share in hot.items():
        wanted = max(2, share * partitions * BUCKETS_PER_PARTITION)
        groups.setdefault(2 ** ceil(log2(wanted)), []).append(key)
    return groups


def _cell(own: Column, side: int, step: bool) -> Callable[[Column], Column]:
    """Number of a grid's cell from the row (with ``step``) or column that a side picked."""
    return lambda other: own * side + other if step else other * side + own


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
) -> DataFrame:
    """Equi-join for sides that may hold hot keys.

    The rows of a key that is hot on one side are spread over buckets there, and the other
    side's rows of just that key are copied into each bucket. A key that is hot on both sides
    gets a grid of buckets: left rows are copied along one of its rows, right rows along one of
    its columns, so copies grow with the root of the buckets. All other keys are joined as usual. The result is the plain join's, row for row, and without hot keys so is the
    plan. A left join spreads its left side only, so its right side should be aggregated
    to few rows per key.

    The hot keys come from ``hot_keys`` of either side, which is called here for a side
    not given. Rows are spread by the number ``with_row_salt`` gave them; rows without one
    by their hash, which spreads all but identical copies. The left numbers are kept.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does inner and left joins, not {how}")
    keys = list(on)
    if hot_left is None:
        (hot_left,) = hot_keys(left, keys)
    if how == "left":
        hot_right = {}
    elif hot_right is None:
        (hot_right,) = hot_keys(right.select(*(F.col(c).cast(left.schema[c].dataType) for c in keys)), keys)
    on_both = {k: max(share, hot_right[k]) for k, share in hot_left.items() if k in hot_right}
    spread_left, spread_right = (
        _by_buckets(left, {k: share for k, share in hot.items() if k not in on_both}) for hot in (hot_left, hot_right)
    )
    grids: dict[int, list[int]] = {}
    for buckets, ids in _by_buckets(left, on_both).items():
        grids.setdefault(2 ** ceil(log2(buckets) / 2), []).extend(ids)
    if not spread_left and not spread_right and not grids:
        return left.join(right.drop(ROW_SALT), keys, how)

    def salted(df: DataFrame, spread: Mapping[int, list[int]], copied: Mapping[int, list[int]], step: bool) -> DataFrame:
        """``step``: in a grid this side picks a row and is copied along it, else a column."""
        key_id = _key_id(df, keys, left)
        number = F.col(ROW_SALT) if ROW_SALT in df.columns else F.xxhash64(*df.columns)
        pick = lambda n: F.pmod(number, F.lit(n)).cast("int")
        every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
        one = [F.when(key_id.isin(ids), pick(n)) for n, ids in spread.items()]
        bucket = F.coalesce(*one, F.lit(0))
        if not copied and not grids:
            return df.withColumn("_salt", bucket)
        many = [F.when(key_id.isin(ids), every(n)) for n, ids in copied.items()]
        for n, ids in grids.items():
            own = pick(n)
            line = F.transform(every(n), _cell(own, n, step))
            many.append(F.when(key_id.isin(ids), line))
        return df.withColumn("_salt", F.explode(F.coalesce(*many, F.array(bucket))))

    salted_left = salted(left, spread_left, spread_right, True)
    salted_right = salted(right, spread_right, spread_left, False).drop(ROW_SALT)
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def replicate_rows(df: DataFrame, copies: str, most: int | None = None) -> DataFrame:
    """Each row ``copies`` times, the count column dropped; rows with none vanish.

    ``most`` is the largest count where it is known: a small one needs a single pass. A row with a great many copies is cut into chunks that are spread over the cluster
    before they are unfolded. The frame is read for the two cases apart, so it should be
    a stored table or the result of a shuffle, which is computed once.
    """
    data = [f"`{c}`" for c in df.columns if c != copies]
    n = F.col(copies).cast("long")
    if most is not None and most <= COPIES_PER_CHUNK:
        unfolded = df.filter(n >= 1).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), n)))
        return unfolded.select(*data)
    few = (
        df.filter((n >= 1) & (n <= COPIES_PER_CHUNK))
        .select(*data, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("_copy"))
    )
    chunk = F.sequence(F.lit(1).cast("long"), F.ceil(n / COPIES_PER_CHUNK))
    left_over = n - (F.col("_chunk") - 1) * COPIES_PER_CHUNK
    many = (
        df.filter(n > COPIES_PER_CHUNK)
        .withColumn("_chunk", F.explode(chunk))
        .withColumn("_in_chunk", F.least(F.lit(COPIES_PER_CHUNK).cast("long"), left_over))
        .repartition("_chunk", *data)
        .select(*data, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_in_chunk"))).alias("_copy"))
    )
    return few.unionByName(many).drop("_copy")
