"""Point-in-polygon join (J16): a cover of cells that fit each polygon, then ray-crossing parity.

1. Every polygon (one ring, or several: parts and holes, by the even-odd rule) gets cells of a size
   of its own, a power of two at which it has a few cells per edge. Cells that an edge may pass are
   border cells; the others are wholly inside or outside, which one parity test of their middle
   decides, and only inner ones are kept.
2. Points join on their cell, once for each cell size in use. A point in an inner cell is inside
   without any edge test; a point in a border cell meets only the edges in its row of cells.
3. An edge counts when it straddles the point's y (half-open, so a vertex is counted once) and
   crosses the horizontal ray to the right of the point; odd = inside.
A point inside several polygons keeps the smallest polygon id (one polygon per point).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.operators.sizing import broadcast_if_small


def _cell(v: Column, size: Column) -> Column:
    return F.floor(v / size).cast("long")


def polygon_edges(polygons: DataFrame, *, id_col: str = "polygon_id", ring_col: str = "ring") -> DataFrame:
    """``ring_col`` ARRAY<STRUCT<x,y>>, or an array of such rings (each open or closed) → one row per edge (x1, y1, x2, y2)."""
    many = polygons.schema[ring_col].dataType.simpleString().startswith("array<array<")
    rings = polygons.select(id_col, F.explode(ring_col).alias("r")) if many else polygons.select(id_col, F.col(ring_col).alias("r"))
    e = rings.where(F.size("r") > 0).select(id_col, "r", F.explode(F.sequence(F.lit(0), F.size("r") - 1)).alias("i"))
    a = F.col("r")[F.col("i")]
    b = F.col("r")[F.pmod(F.col("i") + 1, F.size("r"))]
    return e.select(id_col, a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")) \
            .where(~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))))


def _crosses(px: Column, py: Column) -> Column:
    straddle = (F.col("y1") > py) != (F.col("y2") > py)
    return straddle & (px < F.col("x1") + (py - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))


def cover(edges: DataFrame, polygon_id: str = "polygon_id") -> tuple[DataFrame, DataFrame]:
    """(cells, edge rows): (polygon, size, cx, cy, inner) of inner and border cells, and each edge in the rows of cells it spans."""
    x, y = (F.least("x1", "x2"), F.greatest("x1", "x2")), (F.least("y1", "y2"), F.greatest("y1", "y2"))
    box = edges.groupBy(polygon_id).agg(F.min(x[0]).alias("minx"), F.max(x[1]).alias("maxx"), F.min(y[0]).alias("miny"),
                                        F.max(y[1]).alias("maxy"), F.count(F.lit(1)).alias("n"))
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    box = box.withColumn("size", F.pow(F.lit(2.0), F.floor(F.log2(extent / (2 * F.sqrt("n"))))))
    size = F.col("size")
    rows = edges.join(box.select(polygon_id, "size"), polygon_id).select("*", F.explode(F.sequence(_cell(y[0], size), _cell(y[1], size))).alias("cy"))
    # the edge's stretch inside its row, a little widened, gives the border cells
    bottom, top = F.greatest(y[0], F.col("cy") * size), F.least(y[1], (F.col("cy") + 1) * size)
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    at = [F.coalesce(F.col("x1") + (v - F.col("y1")) * slope, F.lit(0.0)) for v in (bottom, top)]
    flat = F.col("y1") == F.col("y2")
    lo, hi = F.when(flat, x[0]).otherwise(F.least(*at)), F.when(flat, x[1]).otherwise(F.greatest(*at))
    slack = 1e-9 * (size + F.abs(lo) + F.abs(hi))
    passed = rows.select(polygon_id, "size", "cy", F.explode(F.sequence(_cell(lo - slack, size), _cell(hi + slack, size))).alias("cx"))
    # an edge on the line between two rows passes both
    touch = F.floor((y[0] - 1e-9 * (size + F.abs(y[0]))) / size).cast("long")
    above = edges.join(box.select(polygon_id, "size"), polygon_id).select(
        polygon_id, "size", touch.alias("cy"), x[0].alias("a"), x[1].alias("b")).where(touch < _cell(y[0], size)).select(
        polygon_id, "size", "cy", F.explode(F.sequence(_cell(F.col("a") - 1e-9 * (size + F.abs("a")), size),
                                                       _cell(F.col("b") + 1e-9 * (size + F.abs("b")), size))).alias("cx"))
    border = passed.unionByName(above).distinct()
    grid = box.select(polygon_id, "size", F.explode(F.sequence(_cell(F.col("minx"), size), _cell(F.col("maxx"), size))).alias("cx"),
                      F.sequence(_cell(F.col("miny"), size), _cell(F.col("maxy"), size)).alias("ys"))
    clear = grid.select(polygon_id, "size", "cx", F.explode("ys").alias("cy")).join(border, [polygon_id, "size", "cx", "cy"], "left_anti")
    mid = (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size
    crossed = clear.join(rows.drop("size"), [polygon_id, "cy"]).where(_crosses(*mid))
    inner = crossed.groupBy(polygon_id, "size", "cx", "cy").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") % 2 == 1).drop("c")
    return inner.withColumn("inner", F.lit(True)).unionByName(border.withColumn("inner", F.lit(False))), rows.drop("size")


def candidates(points: DataFrame, cells: DataFrame) -> DataFrame:
    """(pid, px, py, polygon, cy, inner): each point with the cells it lies in, one lookup per cell size in use."""
    sizes = [r["size"] for r in cells.select("size").distinct().collect()]  # powers of two: at most some 2,000, usually a few
    pts = points.withColumn("size", F.explode(F.array(*[F.lit(float(s)) for s in sizes]))) if sizes else points.withColumn("size", F.lit(1.0)).limit(0)
    pts = pts.withColumns({"cx": _cell(F.col("px"), F.col("size")), "cy": _cell(F.col("py"), F.col("size"))})
    # cells and edge rows follow the polygons' geometry, not the number of points: broadcast them
    # (size-checked) so points never shuffle by cell (no hot cell task)
    return pts.join(broadcast_if_small(cells), ["size", "cx", "cy"]).drop("size", "cx")


def within(points: DataFrame, polygons: DataFrame, *, point_id: str = "point_id", x: str = "x", y: str = "y",
           polygon_id: str = "polygon_id", ring: str = "ring") -> DataFrame:
    """(point_id, polygon_id) for every point strictly inside a polygon (even-odd rule over all its rings)."""
    cells, rows = cover(polygon_edges(polygons, id_col=polygon_id, ring_col=ring), polygon_id)
    met = candidates(points.select(F.col(point_id).alias("pid"), F.col(x).alias("px"), F.col(y).alias("py")), cells)
    hits = met.where("not inner").join(broadcast_if_small(rows), [polygon_id, "cy"]).where(_crosses(F.col("px"), F.col("py")))
    odd = hits.groupBy("pid", polygon_id).agg(F.count(F.lit(1)).alias("crossings")).where(F.col("crossings") % 2 == 1)
    sure = met.where("inner").select("pid", polygon_id)
    one = odd.select("pid", polygon_id).unionByName(sure).groupBy("pid").agg(F.min(polygon_id).alias(polygon_id))
    return one.withColumnRenamed("pid", point_id)
