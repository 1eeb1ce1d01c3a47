"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue in a shuffled order that a hash of their id fixes. The virtual
finish time of a queued copy is the number of its source's words up to and including it,
divided by the source's target; taking all copies in order of finish time serves sources in
proportion to their targets, and the mix ends where the word budget does.

Both running sums are two-level: sums by a range of the order, then inside the range, so a
source with a third of all rows is spread over as many ranges as its rows call for, and
ranges follow the number of rows. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import row_order, stage, word_count

#: Rows of a range of a running sum, on average.
RANGE_ROWS = 5_000


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """``source, source_size, docs, target`` from ``source, source_size, docs``: one row each.

    Weights repeat over the sources by code point, NULL last. A target is its weight's part of
    ``share`` times all words; where that is above ``epochs`` times the source's words, the
    excess goes to the others by weight. In order of words per weight the sources that stop
    at their cap come first, so the level of the rest follows from running sums.
    """
    everything = Window.partitionBy()  # the table of sources: one row for each weight
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*(F.lit(w) for w in weights))
    weighed = sizes.withColumn("weight", F.get(listed, (F.row_number().over(by_name) - 1) % len(weights)))
    cap = (F.col("source_size") * epochs).cast("double")
    ordered = weighed.withColumns({"cap": cap, "fill": cap / F.col("weight")})
    by_fill = Window.orderBy("fill", F.col("source").isNull(), "source")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    level = ordered.withColumns(
        {
            "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
        }
    ).withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
    # the first source with room at its level sets that of all that follow; theirs are no higher
    final = level.withColumn(
        "final", F.max(F.when(F.col("fill") >= F.col("level"), F.col("level"))).over(everything)
    )
    target = F.when(F.col("final").isNull() | (F.col("fill") < F.col("final")), F.col("cap"))
    return final.select(
        "source", "source_size", "docs", target.otherwise(F.col("weight") * F.col("final")).alias("target")
    )


def _running(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Add the inclusive running sum of ``value`` over ``order`` within ``group``; ``bucket``
    numbers ranges of that order."""
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.withColumn("_inside", F.sum(value).over(inside))
    same = F.lit(True)
    for k in keys:
        same = same & summed[k].eqNullSafe(offsets[k])
    return summed.join(offsets, same).select(
        *(summed[c] for c in df.columns), (F.col("_inside") + F.col("_offset")).alias(out)
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row of
    ``docs (doc_id, text, source, ...)``.

    ``taken`` is ``size`` times ``copies``, how often the mix takes the document: 0 to
    ``epochs``. A NULL text, like one without words, has size 0, is never queued and has no
    copies; NULL is a source of its own. Repeated rows queue one by one; equal ids of one
    source go by size. Without any word all targets and shares are 0; an empty table gives no
    rows.
    """
    sized = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text").cast("string")).alias("size"),
        ).withColumn("turn", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))),
        "mix",
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("docs")
    )
    aims = stage(targets(sources, weights, share, epochs), "mix-targets")
    joined = sized.join(aims, sized["source"].eqNullSafe(aims["source"])).select(
        sized["source"], "doc_id", "size", "turn", "source_size", "docs", "target"
    )
    queued = joined.where("size > 0").withColumn(
        "range",
        # the leading 24 bits of the hash, cut into as many ranges as the source's rows need
        F.floor(
            F.conv(F.substring("turn", 1, 6), 16, 10).cast("long")
            * F.ceil(F.col("docs") / RANGE_ROWS)
            / F.lit(1 << 24)
        ),
    )
    order = [F.col("turn"), F.col("doc_id"), F.col("size")]
    queued = _running(queued, ["source"], "range", order, "size", "served")
    queued = stage(queued.drop("range"), "mix-queue")
    totals = aims.agg(F.sum("docs").alias("docs"), F.sum("source_size").alias("words")).first()
    budget, ranges = (totals["words"] or 0) * share, max(1, -(-(totals["docs"] or 0) // RANGE_ROWS))

    def finish(epoch: int) -> Column:
        served = F.col("served") + F.col("source_size") * epoch
        return served.cast("double") / F.col("target")

    # Copies in order of finish time: sums by range of time, then the one range in which the
    # budget ends is put in order. All copies up to the last one that fits are taken.
    copies = queued.select(
        "source",
        "size",
        F.col("turn"),
        "doc_id",
        F.explode(F.array(*(F.struct(F.lit(e).alias("epoch"), finish(e).alias("at")) for e in range(epochs)))).alias("c"),
    ).select("source", "size", "turn", "doc_id", "c.epoch", "c.at")
    copies = copies.withColumn("range", F.least(F.floor(F.col("at") * ranges), F.lit(4 * ranges)))
    by_range = Window.orderBy("range")
    sums = copies.groupBy("range").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(by_range))
    last = sums.where(F.col("upto") > budget).orderBy("range").first()
    if last is None:
        fits = lambda e: F.lit(True)
    else:
        spare = budget - (last["upto"] - last["words"])
        ties = [F.col("at"), F.col("source").asc_nulls_last(), F.col("epoch"), F.col("turn"), F.col("doc_id"), F.col("size")]
        upto = Window.orderBy(*ties).rowsBetween(Window.unboundedPreceding, 0)
        edge = (
            copies.where(F.col("range") == last["range"])
            .withColumn("upto", F.sum("size").over(upto))
            .where(F.col("upto") > spare)
            .orderBy("upto")
            .select("at", "source", "epoch", "turn", "doc_id")
            .first()
        )

        def fits(e: int) -> Column:
            """Whether a document's copy comes before the first copy that is too much."""
            mine = finish(e)
            named = F.lit(edge["source"]).cast("string")
            source_before = (F.col("source") < named) if edge["source"] is not None else F.col("source").isNotNull()
            same_source = F.col("source").eqNullSafe(named)
            earlier = (F.col("turn") < F.lit(edge["turn"])) | (F.lit(e) < F.lit(edge["epoch"]))
            tied = F.coalesce(source_before, F.lit(False)) | (same_source & earlier)
            return (mine < F.lit(edge["at"])) | ((mine == F.lit(edge["at"])) & tied)

    taken = sum((F.when(fits(e), 1).otherwise(0) for e in range(epochs)), F.lit(0))
    used = queued.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("copies"))
    unused = joined.where("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("copies"))
    return used.union(unused).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken. Of rows
    with equal ids and sizes, those that come first by all their columns (``row_order``) get the
    odd copies; the order of the input has no influence."""
    plan = mix(docs, **options).select(F.col("doc_id").alias("__id"), F.col("size").alias("__words"), "copies")
    # rows with equal ids and sizes share their copies out evenly
    per_id = plan.groupBy("__id", "__words").agg(F.sum("copies").alias("__sum"), F.count("*").alias("__rows"))
    rows = docs.select(F.struct("*").alias("__row"), word_count(F.col("text").cast("string")).alias("__size"))
    hit = rows.join(
        per_id.where("__sum > 0"),
        rows["__row.doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__words")),
    )
    nth = F.row_number().over(Window.partitionBy("__id", "__words").orderBy(*row_order(docs)))
    times = F.floor((F.col("__sum") + F.col("__rows") - F.col("__nth")) / F.col("__rows")).cast("int")
    each = hit.withColumn("__nth", nth).withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times)))
    return each.select("__row.*")
