"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are rotated to principal axes, largest variance first. A pair's cosine is the
product over the leading axes plus a rest that Cauchy-Schwarz bounds by the product of the
two suffix norms; a pair is dropped as soon as the bound is below the threshold, a pair of
groups before anything is compared if the boxes around them allow no link.

Equal vectors are grouped first. Groups for comparison are cells of the leading axes' signs,
split by a hash of the vector where a cell holds more than ``GROUP_ROWS``, or fewer where
cores would have nothing to do: each task sees two groups of bounded size, never all rows of a
cell, and hands on per-vector counts and a spanning forest of its links instead of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from .common import stage
from .components import components, lowest_of

#: Most and least vectors in a group for comparison, on average; in between there are as many
#: groups as give each core this many pairs of them.
GROUP_ROWS, LEAST_ROWS, PAIRS_PER_CORE = 8192, 512, 3
#: Groups whose boxes are broadcast at a time, 200 bytes each.
BOX_BLOCK = 50_000
#: Vectors that the principal axes are fitted on; axes only decide the order of work.
SAMPLE_ROWS = 4096
#: Axes whose ranges are kept for each group, and most sign bits of a cell.
BOX_AXES = 12
#: Rows of a tile, and axes that are added before the next bound.
TILE, AXES = 1024, 16
#: Rounding that rotation may add to a cosine; pairs this near the threshold are computed again.
SLACK = 1e-9


def principal_axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: orthonormal axes of unit vectors, largest second moment first."""
    _, axes = np.linalg.eigh(vectors.T @ vectors)
    return axes[:, ::-1].copy()


def usable(column: str) -> Column:
    """Not NULL, not empty, no NULL or non-finite component, not all zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Tile:
    """Vectors with their leading coordinates and suffix norms."""

    def __init__(self, raw: np.ndarray, axes: np.ndarray):
        self.units = unit(raw)
        self.turned = self.units @ axes
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.hstack([squares, np.zeros((len(raw), 1))]))

    def part(self, start: int) -> "Tile":
        out = object.__new__(Tile)
        for name in ("units", "turned", "suffix"):
            setattr(out, name, getattr(self, name)[start : start + TILE])
        return out


def linked(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs with cosine at or above the threshold."""
    least, width, at = threshold - SLACK, a.turned.shape[1], AXES
    so_far = a.turned[:, :at] @ b.turned[:, :at].T
    if at < width:
        i, j = np.nonzero(so_far + a.suffix[:, at, None] * b.suffix[:, at] >= least)
        dense = len(i) > so_far.size // 8
        if dense:
            so_far += a.turned[:, at:] @ b.turned[:, at:].T
            i, j = np.nonzero(so_far >= least)
        product = so_far[i, j]
        while not dense and at < width and len(i):
            stop = min(at + AXES, width)
            product = product + np.einsum("ij,ij->i", a.turned[i, at:stop], b.turned[j, at:stop])
            alive = product + a.suffix[i, stop] * b.suffix[j, stop] >= least
            i, j, product, at = i[alive], j[alive], product[alive], stop
    else:
        i, j = np.nonzero(so_far >= least)
        product = so_far[i, j]
    unsure = np.abs(product - threshold) <= SLACK
    product[unsure] = np.einsum("ij,ij->i", a.units[i[unsure]], b.units[j[unsure]])
    sure = product >= threshold
    return i[sure], j[sure]


def spanning(pairs: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those pairs that join two trees of a growing forest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y in pairs:
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            yield x, y


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def compared(both: pa.Table, axes: np.ndarray, threshold: float) -> pa.Table:
    """``node, links, other`` of two groups, told apart by ``side``, or of one with itself."""
    a, b = (both.filter(pc.equal(both["side"], side)) for side in (0, 1))
    same = b.num_rows == 0
    tables = (a,) if same else (a, b)
    nodes, copies = ([t[c].to_numpy() for t in tables] for c in ("node", "copies"))
    tiles = [Tile(_matrix(t["v"]), axes) for t in tables]
    counts = [np.zeros(t.num_rows, dtype=np.int64) for t in tables]
    forest: list[tuple[int, int]] = []
    for p in range(0, tables[0].num_rows, TILE):
        for q in range(p if same else 0, tables[-1].num_rows, TILE):
            i, j = linked(tiles[0].part(p), tiles[-1].part(q), threshold)
            if same and p == q:
                i, j = i[i < j], j[i < j]
            i, j = i + p, j + q
            np.add.at(counts[0], i, copies[-1][j])
            np.add.at(counts[-1], j, copies[0][i])
            forest += spanning(zip(nodes[0][i].tolist(), nodes[-1][j].tolist()))
    forest = list(spanning(forest))
    some = [np.flatnonzero(c) for c in counts]
    node = np.concatenate([*(n[s] for n, s in zip(nodes, some)), np.array([x for x, _ in forest], dtype=np.int64)])
    links = np.concatenate([*(c[s] for c, s in zip(counts, some)), np.zeros(len(forest), dtype=np.int64)])
    other = [None] * (len(node) - len(forest)) + [y for _, y in forest]
    return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64()), "other": pa.array(other, pa.int64())})


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding)``.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component link with
    nothing, and neither do vectors of different lengths. Repeated rows link with each other.
    ``kept`` says whether ``vec_id`` is the smallest id of its component; a row without id
    never is, unless no row of its component has one. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).withColumn("v", F.when(usable("v"), F.col("v")))
    reps = stage(
        rows.where("v IS NOT NULL")
        .groupBy("v")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    sizes = {r["d"]: r["n"] for r in reps.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    counted = [_compared(reps.where(F.size("v") == d), n, threshold) for d, n in sorted(sizes.items())]
    rooted = reps.select("v", "node", "first_id", "copies")
    if counted:
        found = counted[0]
        for more in counted[1:]:
            found = found.union(more)
        found = stage(found, "vector-links")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors")
        rooted = rooted.join(links, "node", "left").join(roots, "node", "left")
    else:
        rooted = rooted.withColumns({"links": F.lit(0), "component": F.lit(None).cast("long")})
    rooted = stage(rooted.withColumn("root", F.coalesce("component", "node")), "vector-roots")
    labels = lowest_of(rooted, "root", "first_id", "component_id").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    placed = rows.join(labels, "v", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return placed.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _compared(reps: DataFrame, n: int, threshold: float) -> DataFrame:
    """``node, links, other`` of vectors of one length: shares of the links of a vector, and
    links of a spanning forest of each pair of groups."""
    spark = reps.sparkSession
    sample = reps.orderBy(F.xxhash64("v")).limit(SAMPLE_ROWS).select("v").toArrow()["v"]
    axes = principal_axes(unit(_matrix(sample)))
    width = axes.shape[0]
    box = min(BOX_AXES, width)
    cores = spark.sparkContext.defaultParallelism
    group_rows = min(GROUP_ROWS, max(LEAST_ROWS, math.ceil(n / math.sqrt(2 * PAIRS_PER_CORE * cores))))
    bits = min(box, max(0, math.ceil(math.log2(max(1, n / group_rows)))))
    box_columns = [f"x{k}" for k in range(box)]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tile = Tile(_matrix(pa.chunked_array([batch.column("v")])), axes) if batch.num_rows else None
            if tile is None:
                continue
            cell = (tile.turned[:, :bits] > 0) @ (1 << np.arange(bits)) if bits else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "copies", "v")),
                    pa.array(cell.astype(np.int64)),
                    *(pa.array(tile.turned[:, k].copy()) for k in range(box)),
                    pa.array(tile.suffix[:, box].copy()),
                ],
                ["node", "copies", "v", "cell", *box_columns, "rest"],
            )

    placed = reps.select("node", "copies", "v").mapInArrow(
        place,
        "node long, copies long, v array<double>, cell long, "
        + "".join(f"{c} double, " for c in box_columns)
        + "rest double",
    )
    placed = stage(placed, "vector-cells")
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / group_rows).alias("parts"))
    grouped = placed.join(F.broadcast(cells), "cell").withColumn(  # at most 2 ** BOX_AXES cells
        "grp", F.struct("cell", F.pmod(F.xxhash64("v"), "parts").alias("part"))
    )
    grouped = grouped.withColumn("grp", F.col("grp.cell") * (1 << 32) + F.col("grp.part"))
    ranges = [f(c).alias(f"{f.__name__}_{c}") for c in box_columns for f in (F.min, F.max)]
    boxes = stage(grouped.groupBy("grp").agg(*ranges, F.max("rest").alias("rest")), "vector-boxes")
    lows, highs = ([f"{f}_{c}" for c in box_columns] for f in ("min", "max"))

    def partners(held: Broadcast):
        def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            every = held.value
            low, high = every[lows].to_numpy(), every[highs].to_numpy()
            ids, rest = every["grp"].to_numpy(), every["rest"].to_numpy()
            for frame in frames:
                own = zip(frame["grp"], frame["rest"], frame[lows].to_numpy(), frame[highs].to_numpy())
                for group, own_rest, lo, hi in own:
                    most = np.maximum.reduce([lo * low, lo * high, hi * low, hi * high]).sum(axis=1)
                    near = (ids >= group) & (most + rest * own_rest >= threshold - SLACK)
                    yield pd.DataFrame({"g": np.int64(group), "h": ids[near]})

        return run

    blocks, pairs = -(-boxes.count() // BOX_BLOCK), None
    for block in range(max(1, blocks)):
        # the boxes of one block at a time, whatever the number of groups
        some = boxes if blocks <= 1 else boxes.where(F.pmod(F.xxhash64("grp"), F.lit(blocks)) == block)
        found = boxes.mapInPandas(partners(spark.sparkContext.broadcast(some.toPandas())), "g long, h long")
        pairs = found if pairs is None else pairs.union(found)
    pairs = stage(pairs, "vector-pairs")
    sides = pairs.select(F.col("g").alias("grp"), "g", "h", F.lit(0).alias("side")).union(
        pairs.where("g <> h").select(F.col("h").alias("grp"), "g", "h", F.lit(1).alias("side"))
    )
    met = grouped.select("grp", "node", "copies", "v").join(sides, "grp").select("g", "h", "side", "node", "copies", "v")

    def compare(both: pa.Table) -> pa.Table:
        return compared(both, axes, threshold)

    # two groups of bounded size
    return met.groupBy("g", "h").applyInArrow(compare, "node long, links long, other long")
