"""Points in sectors: a grid cover of the polygons, an equi-join by cell, ray casting at borders only.

A cell that a polygon covers whole is an inner cell, and a point in it is in the polygon without a test; one that an
edge passes through is a border cell, where the point is tested against the polygon's edges. Other cells have no row.
So a point meets the polygons of its cell, not all of them, and the join is on the cell: a cell that many points
share is a skewed key of the large side, which Spark splits.

Where only sums by sector are asked for, `totals` makes no pairs: inner cells add the sums of their points, and the points
of a border cell are compared as columns with the edges that pass at their height.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGES = "array<struct<x1: double, y1: double, x2: double, y2: double>>"
#: Rows of an Arrow batch of cells.
ROWS = 8192


def edges_of(corners: Column) -> Column:
    """The edges of a polygon, given as an array of corners {x, y}; the last corner is joined to the first."""
    n = F.size(corners)
    edge = lambda i: F.struct(corners[i]["x"].alias("x1"), corners[i]["y"].alias("y1"), corners[(i + 1) % n]["x"].alias("x2"), corners[(i + 1) % n]["y"].alias("y2"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: edge(i.cast("int")))


def crosses(x: Column, y: Column, e: Column) -> Column:
    """Whether a ray from (x, y) to the right crosses an edge: half open in y, so a corner counts once."""
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def inside(x: Column, y: Column, edges: Column) -> Column:
    """Ray casting over an array of edges. A corner's or an edge's own points belong to one side, always the same."""
    return F.aggregate(edges, F.lit(0), lambda n, e: n + F.when(crosses(x, y, e), 1).otherwise(0)) % 2 == 1


def _contains(x: float, y: float, edges: list) -> bool:
    n = 0
    for e in edges:
        if (e["y1"] > y) != (e["y2"] > y) and x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]:
            n += 1
    return n % 2 == 1


def _touched(e, side: float) -> set[tuple[int, int]]:
    """Cells that an edge passes through or touches, and their neighbours where it runs along a border."""
    out = set()
    low, high = sorted((e["y1"], e["y2"]))
    for row in range(math.floor(low / side) - 1, math.floor(high / side) + 2):
        bottom, top = max(low, row * side), min(high, (row + 1) * side)
        if bottom > top:
            continue
        if e["y1"] == e["y2"]:
            xs = (e["x1"], e["x2"])
        else:
            xs = [e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) for y in (bottom, top)]
        slack = 1e-9 * max(1.0, *map(abs, xs))  # what rounding may have moved
        out |= {(column, row) for column in range(math.floor((min(xs) - slack) / side), math.floor((max(xs) + slack) / side) + 1)}
    return out


def cover(polygons: DataFrame, sector: str, corners: str, side: float) -> DataFrame:
    """sector, cx, cy and edges (null for inner cells) of the cells of each polygon; a row for each cell, so the
    side decides between more cells and more border."""
    spread = 2 * polygons.sparkSession.sparkContext.defaultParallelism  # said, as a polygon is small beside its cells
    shaped = polygons.select(F.col(sector).alias("sector"), edges_of(F.col(corners)).alias("edges")).repartition(spread, "sector")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, shapes = batch.column("sector"), batch.column("edges")
            rows = []  # (place of the polygon, cx, cy, its place again at a border)
            for i, edges in enumerate(shapes.to_pylist()):
                border = set().union(*(_touched(e, side) for e in edges))
                rows += [(i, cx, cy, i) for cx, cy in border]
                by_row = defaultdict(list)
                for cx, cy in border:
                    by_row[cy].append(cx)
                for row, own in by_row.items():
                    own.sort()
                    for a, b in zip(own, own[1:], strict=False):  # between border cells a row of cells is all in or all out
                        if b - a > 1 and _contains((a + 1.5) * side, (row + 0.5) * side, edges):
                            rows += [(i, cx, row, None) for cx in range(a + 1, b)]
                if len(rows) >= ROWS or i == len(shapes) - 1:
                    for start in range(0, len(rows), ROWS):
                        at, cx, cy, shape = zip(*rows[start : start + ROWS], strict=True)
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(at)), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), shapes.take(pa.array(shape, pa.int64()))], names=["sector", "cx", "cy", "edges"])
                    rows = []

    kind = shaped.schema["sector"].dataType.simpleString()
    return shaped.mapInArrow(cells, f"sector {kind}, cx long, cy long, edges {EDGES}")


def located(points: DataFrame, x: str, y: str, covered: DataFrame, side: float) -> DataFrame:
    """`points` with the sector of every polygon that they lie in; points outside of all have no row, those in several
    have several."""
    place = points.withColumns({"_cx": F.floor(F.col(x) / side), "_cy": F.floor(F.col(y) / side)})
    met = place.join(covered, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy")))
    return met.filter(F.col("edges").isNull() | inside(F.col(x), F.col(y), F.col("edges"))).select(*points.columns, "sector")


def _tested(places: pa.Table, borders: pa.Table) -> Iterator[tuple[int, int, int]]:
    """(place of the sector, n, total) over places of one cell, given as columns; a ray is cast as in `crosses`."""
    column = lambda t, name: t.column(name).combine_chunks().to_numpy(zero_copy_only=False)
    ys = column(places, "_y")
    order = np.argsort(ys)
    ys, xs, n, total = ys[order], column(places, "_x")[order], column(places, "n")[order], column(places, "total")[order]
    if np.abs(total.astype(float)).sum() >= 2**63:
        raise OverflowError("a sum of a cell's values needs more than 64 bits")
    shapes = borders.column("edges").combine_chunks()
    x1, y1, x2, y2 = (shapes.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
    # an edge is crossed at heights from its lower end, which counts, to its upper end, which does not
    first, last = np.searchsorted(ys, np.minimum(y1, y2)), np.searchsorted(ys, np.maximum(y1, y2))
    slack = 1e-9 * np.maximum(1.0, np.maximum(np.abs(x1), np.abs(x2)))
    open_ = (first < last) & (np.maximum(x1, x2) + slack >= xs.min())
    beyond = np.minimum(x1, x2) - slack > xs.max()  # right of all places
    inside = np.empty(len(ys), bool)
    ends = np.cumsum(shapes.value_lengths().to_numpy())
    begin = 0
    for i, end in enumerate(ends):
        inside[:] = False
        for k in begin + np.flatnonzero(open_[begin:end]):
            a, b = first[k], last[k]
            inside[a:b] ^= True if beyond[k] else xs[a:b] < (x2[k] - x1[k]) * (ys[a:b] - y1[k]) / (y2[k] - y1[k]) + x1[k]
        if inside.any():
            yield i, int(n[inside].sum()), int(total[inside].sum())
        begin = end


def totals(points: DataFrame, x: str, y: str, value: str, covered: DataFrame, side: float, most: int = 8192) -> DataFrame:
    """sector, n and total: how many points lie in each sector and the sum of their whole numbers `value` (null: 0);
    sectors without points have no row. What `located` gives, grouped, without its pairs.

    A cell of more than `most` different places, or of more than `most` sectors' borders, is dealt into parts, each two of
    which meet in a task."""
    cell = ["cx", "cy"]
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    places = points.select(F.floor(px / side).alias("cx"), F.floor(py / side).alias("cy"), px.alias("_x"), py.alias("_y"), F.col(value).cast("long").alias("_value"))
    places = places.dropna(subset=cell).groupBy(*cell, "_x", "_y").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_value"), F.lit(0)).alias("total"))
    sums = places.groupBy(*cell).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("_places"))
    # merge joins: a cover is far larger than the polygons by which Spark estimates it, and must not be broadcast
    inner = covered.filter("edges is null").hint("merge").join(sums, cell).groupBy("sector").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    border = covered.filter("edges is not null").hint("merge")
    part = lambda name: F.ceil(F.col(name) / most).cast("int")
    dealt = sums.join(border.groupBy(*cell).agg(F.count(F.lit(1)).alias("_borders")).hint("merge"), cell).select(*cell, part("_places").alias("_parts"), part("_borders").alias("_shares"))
    own = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = places.join(dealt, cell).select(*cell, own("_parts", "_x", "_y").alias("_part"), every("_shares").alias("_share"), "_x", "_y", "n", "total")
    right = border.join(dealt, cell).select(*cell, every("_parts").alias("_part"), own("_shares", "sector").alias("_share"), "sector", "edges")

    def meet(places: pa.Table, borders: pa.Table) -> pa.Table:
        found = list(_tested(places, borders)) if places.num_rows and borders.num_rows else []
        at, n, total = (pa.array([f[k] for f in found], pa.int64()) for k in range(3))
        return pa.table({"sector": borders.column("sector").take(at), "n": n, "total": total})

    kind = covered.schema["sector"].dataType.simpleString()
    keys = [*cell, "_part", "_share"]
    tested = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"sector {kind}, n long, total long")
    return inner.unionByName(tested).groupBy("sector").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
