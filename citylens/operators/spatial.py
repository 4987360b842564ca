"""Grid-based spatial operators (SP-4 .. SP-8, JN-8 .. JN-10).

All are compositions of explode / equi-join / aggregate on packed hex cell
ids; nothing pairs every row with every other row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.operators.windows import in_total_order
from citylens.session import ensure_checkpoint_dir


# ------------------------------------------------------------------ SP-4 polyfill
def ring_edges(vertices: DataFrame, poly: str = "region_id", ring: str = "ring_id",
               seq: str = "vseq") -> DataFrame:
    """Rings (one row per vertex) -> one row per edge; a ring whose last vertex
    is not its first is closed."""
    w = Window.partitionBy(poly, ring).orderBy(seq)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(whole))
    e = vertices.select(poly, ring, seq, F.col("longitude").alias("x1"), F.col("latitude").alias("y1"),
                        nxt("longitude").alias("x2"), nxt("latitude").alias("y2"))
    return e.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def polyfill(vertices: DataFrame, grid: H.HexGrid = H.COARSE, poly: str = "region_id",
             ring: str = "ring_id", seq: str = "vseq") -> DataFrame:
    """Cells whose centre lies inside a polygon (even-odd rule over all rings).

    Scan-line formulation: every edge is exploded into the cell rows whose
    centre latitude it crosses; per (polygon, row) the crossings are sorted
    and paired, and each pair [xa, xb) yields the run of cells between them.
    Work is proportional to edges x rows crossed + cells produced; there is
    no bounding-box candidate grid and no cell x edge pairing.
    """
    clat, clon = grid.clat, grid.clon
    e = ring_edges(vertices, poly, ring, seq)
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.sequence(F.floor(lo / F.lit(clat)).cast("long") - 1, F.ceil(hi / F.lit(clat)).cast("long") + 1)
    e = e.select(poly, "x1", "y1", "x2", "y2", F.explode(rows).alias("r"))
    yc = F.col("r") * F.lit(clat)
    e = e.where((F.col("y1") > yc) != (F.col("y2") > yc))
    xi = F.col("x1") + (yc - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    # dealt by row: the runs and cells of one region spread over many tasks
    c = e.select(poly, "r", xi.alias("xi")).repartition(poly, "r")
    wr = Window.partitionBy(poly, "r").orderBy("xi")
    c = c.withColumn("pair", F.floor((F.row_number().over(wr) - 1) / 2))
    runs = c.groupBy(poly, "r", "pair").agg(F.min("xi").alias("xa"), F.max("xi").alias("xb"),
                                             F.count(F.lit(1)).alias("n"))
    paired = F.when(F.col("n") == 2, F.col("xa")).otherwise(F.raise_error(F.lit("odd number of ring crossings in a cell row")))
    runs = runs.withColumn("xa", paired)
    half = F.col("r") / F.lit(2.0)
    qs = F.sequence(F.floor(F.col("xa") / F.lit(clon) - half).cast("long") - 1,
                    F.ceil(F.col("xb") / F.lit(clon) - half).cast("long") + 1)
    cells = runs.select(poly, "r", "xa", "xb", F.explode(qs).alias("q"))
    xc = (F.col("q") + F.col("r") / F.lit(2.0)) * F.lit(clon)
    cells = cells.where((xc >= F.col("xa")) & (xc < F.col("xb")))
    return cells.select(poly, H.pack(F.col("q"), F.col("r")).alias("cell")).distinct()


def bbox_rings(points: DataFrame, key: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Closed bounding-box ring (5 vertices) per key, one row per vertex."""
    b = points.groupBy(key).agg(F.min(lat).alias("a"), F.max(lat).alias("b"),
                                F.min(lon).alias("c"), F.max(lon).alias("d"))
    def corner(i, la, lo):
        return F.struct(F.lit(i).alias("vseq"), F.col(la).alias("latitude"), F.col(lo).alias("longitude"))
    corners = F.array(corner(0, "a", "c"), corner(1, "a", "d"), corner(2, "b", "d"),
                      corner(3, "b", "c"), corner(4, "a", "c"))
    return b.select(key, F.inline(corners))


# ------------------------------------------------------------------ SP-3 / JN-10 neighbours
def disk(cells: DataFrame, k: int, cell: str = "cell") -> DataFrame:
    """(cell, nb, ring) for the filled k-disk around each cell (SP-3)."""
    return H.explode_disk(cells.select(cell), k, cell, "nb", "ring")


def present_neighbours(cells: DataFrame, k: int = 1, cell: str = "cell") -> DataFrame:
    """Disk pairs restricted to cells that exist in ``cells`` (JN-10)."""
    d = cells.select(cell).distinct()
    return disk(d, k, cell).join(d.select(F.col(cell).alias("nb")), "nb", "left_semi")


# ------------------------------------------------------------------ SP-5 mesh
def box(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> dict[str, Column]:
    """Bounds of the points as scalar subqueries x0, x1, y0, y1 (no collect, no join)."""
    return {n: points.agg(f(c)).scalar() for n, f, c in
            (("x0", F.min, lon), ("x1", F.max, lon), ("y0", F.min, lat), ("y1", F.max, lat))}


def mesh(points: DataFrame, res: int = 100, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """res x res grid over the points' bounding box, both ends included (SP-5).

    A partitioned ``range`` of res * res rows against scalar bounds; no point
    gives no grid.
    """
    b = box(points, lat, lon)
    step = F.lit(float(max(res - 1, 1)))
    m = points.sparkSession.range(res * res).select(
        F.expr(f"id div {res}").cast("int").alias("i"), F.expr(f"id % {res}").cast("int").alias("j"))
    x = b["x0"] + (b["x1"] - b["x0"]) * F.col("j") / step
    y = b["y0"] + (b["y1"] - b["y0"]) * F.col("i") / step
    return m.select("i", "j", x.alias("mx"), y.alias("my")).where("mx is not null and my is not null")


# ------------------------------------------------------------------ JN-9 nearest sensors
#: Sensors in a leaf of the tree, nodes in a node above, most nodes that every point starts with.
LEAF, FANOUT, TOP = 8, 8, 64


def _spread_bits(c: Column) -> Column:
    """The 31 bits of a number at every second place."""

    def apart(c: Column, shift: int, mask: int) -> Column:          # a lambda, so that c is written once
        return F.transform(F.array(c), lambda b: b.bitwiseOR(F.shiftleft(b, shift)).bitwiseAND(F.lit(mask)))[0]

    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = apart(c, shift, mask)
    return c


def sensor_tree(sensors: DataFrame, sid: str = "sensor_id", carry: list[str] | None = None, leaf: int = LEAF,
                fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame]]:
    """A quadtree cut by counts: placed sensors ``(sid, sx, sy, carry, node)`` and the tree's levels
    ``(node, n, x0, x1, y0, y1)`` from the leaves to one of at most ``TOP`` nodes.

    Sensors are put into quadtree order (interleaved bits of their place in
    the box) and every ``leaf`` consecutive ones are a leaf, whatever their
    density: a far sensor or a thousand at one spot change no other leaf.  A
    node has the box of what it holds; node ``c`` of a level has the nodes
    ``c * fanout ...`` of the level below.
    """
    place = sensors.select(sid, F.col("longitude").alias("sx"), F.col("latitude").alias("sy"), *(carry or [])) \
        .where("sx is not null and sy is not null")
    n, x0, x1, y0, y1 = place.agg(F.count("*"), F.min("sx"), F.max("sx"), F.min("sy"), F.max("sy")).first()
    width = max((x1 or 0.0) - (x0 or 0.0), (y1 or 0.0) - (y0 or 0.0), 1e-9)
    bits = lambda c, low: _spread_bits(F.floor((F.col(c) - F.lit(low or 0.0)) / F.lit(width) * F.lit(2.0 ** 31 - 1)))
    code = F.shiftleft(bits("sy", y0), 1).bitwiseOR(bits("sx", x0))
    placed = in_total_order(place.withColumn("_code", code), ["_code", sid]).drop("_code") \
        .withColumn("node", F.expr(f"_rank div {leaf}")).drop("_rank")
    box_of = [f(c).alias(name) for name, f, c in (("x0", F.min, "sx"), ("x1", F.max, "sx"), ("y0", F.min, "sy"), ("y1", F.max, "sy"))]
    levels = [placed.groupBy("node").agg(F.count("*").alias("n"), *box_of)]
    nodes = -(-n // leaf)
    while nodes > TOP:
        levels.append(levels[-1].groupBy(F.expr(f"node div {fanout}").alias("node")).agg(
            F.sum("n").alias("n"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")))
        nodes = -(-nodes // fanout)
    return placed, levels


def nearest_sensors(points: DataFrame, sensors: DataFrame, k: int, keys: list[str], px: str = "mx", py: str = "my",
                    sid: str = "sensor_id", carry: list[str] | None = None, leaf: int = LEAF, fanout: int = FANOUT) -> DataFrame:
    """The k nearest sensors of every point (planar distance, ties by id), all
    sensors if there are fewer: ``(keys, px, py, sid, sx, sy, carry, dist)``.

    Points go down :func:`sensor_tree` level by level.  Of the nodes that a
    point still looks at, the smallest far distance within which there are k
    sensors bounds its k-th neighbour; nodes that begin beyond it are dropped
    and the others replaced by their children.  What a point looks at is a few
    nodes a level, whatever the sensors' density, and no step pairs points
    with all sensors.
    """
    ensure_checkpoint_dir(sensors.sparkSession)
    placed, levels = sensor_tree(sensors, sid, carry, leaf, fanout)
    box_cols = ["node", "n", "x0", "x1", "y0", "y1"]
    top = levels[-1].agg(F.collect_list(F.struct(*box_cols))).scalar()           # at most TOP nodes
    front = points.select(*keys, px, py).withColumn("_top", top).select(*keys, px, py, F.inline("_top"))
    square = lambda dx, dy: dx * dx + dy * dy
    near = square(F.greatest(F.col("x0") - F.col(px), F.lit(0.0), F.col(px) - F.col("x1")),
                  F.greatest(F.col("y0") - F.col(py), F.lit(0.0), F.col(py) - F.col("y1")))
    far = square(F.greatest(F.col(px) - F.col("x0"), F.col("x1") - F.col(px)), F.greatest(F.col(py) - F.col("y0"), F.col("y1") - F.col(py)))
    of_point = Window.partitionBy(*keys)                                          # the few nodes of one point

    def pruned(front: DataFrame) -> DataFrame:
        held = front.withColumns({"_near": near, "_far": far}).where("_near is not null") \
            .withColumn("_held", F.sum("n").over(of_point.orderBy("_far", "node")))
        bound = F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(of_point)
        # a hair's breadth for the rounding of distances
        return held.withColumn("_bound", bound).where("_bound is null or _near <= _bound * (1 + 1e-9D)").select(*keys, px, py, "node")

    for below in reversed(levels[:-1]):
        children = below.withColumn("_parent", F.expr(f"node div {fanout}"))
        front = pruned(front).withColumnRenamed("node", "_parent").join(children, "_parent").select(*keys, px, py, *box_cols)
    met = pruned(front).join(placed, "node").drop("node").withColumn("dist", S.euclid(px, py, "sx", "sy"))
    return met.withColumn("_rn", F.row_number().over(of_point.orderBy("dist", sid))).where(F.col("_rn") <= k).drop("_rn")


# ------------------------------------------------------------------ SP-6 hull
def _hull_of(points) -> list[tuple[float, float]]:
    """Corners of the convex hull, by monotone chain (a small helper per task)."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def chain(seq):
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and ((out[-1][0] - out[-2][0]) * (p[1] - out[-2][1])
                                    - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return chain(pts) + chain(pts[::-1])


def convex_hull(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Edges ``(x1, y1, x2, y2)`` of the convex hull (one degenerate edge for one point).

    Every task reduces its points to their own hull; the corners of those few
    hulls, and only they, meet in one task.
    """
    xy = points.select(F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y")).where("x is not null and y is not null")

    def corners(batches):
        found: list[tuple[float, float]] = []
        for b in batches:
            found = _hull_of([*found, *zip(b.column("x").to_pylist(), b.column("y").to_pylist())])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.float64()) for i in (0, 1)], names=["x", "y"])

    def edges(batches):
        found = _hull_of([p for b in batches for p in zip(b.column("x").to_pylist(), b.column("y").to_pylist())])
        rows = list(zip(found, found[1:] + found[:1]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i][j] for r in rows], pa.float64()) for i in (0, 1) for j in (0, 1)],
                                             names=["x1", "y1", "x2", "y2"])

    return xy.mapInArrow(corners, "x double, y double").repartition(1).mapInArrow(edges, "x1 double, y1 double, x2 double, y2 double")


# Fixed value: slack of the hull test, in degrees (points on an edge count as inside).
HULL_SLACK = 1e-9


def in_hull(grid: DataFrame, hull: DataFrame, row: str = "i", px: str = "mx", py: str = "my") -> DataFrame:
    """Grid points inside or on the hull (SP-6).

    By grid row: the hull's extent at the row's latitude comes from the edges
    that span it; the points of the row join that one interval.  The edges are
    one array value (the corners of a hull), so no join pairs rows with them.
    """
    upward = F.when(F.col("y1") <= F.col("y2"), F.struct("x1", "y1", "x2", "y2")).otherwise(
        F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2")))
    edges = hull.agg(F.collect_list(upward)).scalar()
    rows = grid.groupBy(row).agg(F.min(py).alias("_y")).withColumn("_e", edges)
    y = F.col("_y")

    def reach(e: Column) -> Column:
        flat = e["y2"] - e["y1"] <= HULL_SLACK
        xi = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.when(~flat, e["y2"] - e["y1"])
        return F.struct(F.when(flat, F.least(e["x1"], e["x2"])).otherwise(xi).alias("a"), F.when(flat, F.greatest(e["x1"], e["x2"])).otherwise(xi).alias("b"))

    met = F.transform(F.filter("_e", lambda e: (e["y1"] - HULL_SLACK <= y) & (y <= e["y2"] + HULL_SLACK)), reach)
    span = rows.withColumn("_met", met).select(row, F.array_min(F.transform("_met", lambda m: m["a"])).alias("_xa"),
                                               F.array_max(F.transform("_met", lambda m: m["b"])).alias("_xb"))
    return grid.join(span, row).where((F.col(px) >= F.col("_xa") - HULL_SLACK) & (F.col(px) <= F.col("_xb") + HULL_SLACK)) \
        .drop("_xa", "_xb")


# ------------------------------------------------------------------ SP-7 interpolation
def idw(pairs: DataFrame, keys: list[str], measures: list[str], power: float = 2.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Inverse-distance weighted measures per point over its paired sensors (SP-7).

    Shepard's weights 1/d^p; a point on a sensor takes that sensor's values
    (the mean of co-located sensors).  ``carry`` columns depend on the keys.
    """
    w = F.when(F.col("dist") > 0, F.lit(1.0) / F.pow(F.col("dist"), F.lit(power)))
    aggs = [F.sum(w).alias("_w")] + [F.min(c).alias(c) for c in carry]
    for m in measures:
        aggs += [F.sum(w * F.col(m)).alias(f"_wz_{m}"), F.avg(F.when(F.col("dist") == 0, F.col(m))).alias(f"_ex_{m}")]
    g = pairs.groupBy(*keys).agg(*aggs)
    return g.select(*keys, *carry, *[F.coalesce(f"_ex_{m}", F.col(f"_wz_{m}") / F.col("_w")).alias(m) for m in measures])


# ------------------------------------------------------------------ SP-7 smooth surface
def _basis(t: Column) -> list[Column]:
    """The four uniform cubic B-splines that reach a cell, at place t (0..1) in it."""
    t2, t3 = t * t, t * t * t
    return [(F.lit(1.0) - t3 + 3.0 * t2 - 3.0 * t) / 6.0, (3.0 * t3 - 6.0 * t2 + 4.0) / 6.0,
            (-3.0 * t3 + 3.0 * t2 + 3.0 * t + 1.0) / 6.0, t3 / 6.0]


def _reached(points: DataFrame, px: str, py: str, extent: tuple[float, float, float, float], cells: int) -> DataFrame:
    """Every point with the 16 lattice nodes ``_c`` around its cell, their weights ``_w`` and the sum ``_all`` of the squared weights."""
    x0, x1, y0, y1 = extent
    out = points
    for axis, p, low, high in (("_s", px, x0, x1), ("_t", py, y0, y1)):
        at = (F.col(p) - F.lit(low)) / F.lit(max(high - low, 1e-9)) * F.lit(float(cells))
        cell = F.greatest(F.least(F.floor(at), F.lit(cells - 1)), F.lit(0))
        out = out.withColumn(f"{axis}i", cell).withColumn(axis, at - F.col(f"{axis}i"))
    # the weights of each axis as an array, so that they are written once
    out = out.withColumns({"_bx": F.array(*_basis(F.col("_s"))), "_by": F.array(*_basis(F.col("_t")))})
    squares = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    out = out.withColumn("_all", squares("_bx") * squares("_by")).drop("_s", "_t")
    out = out.select("*", F.posexplode("_bx").alias("_k", "_wx")).select("*", F.posexplode("_by").alias("_m", "_wy"))
    return out.withColumns({"_c": (F.col("_si") + F.col("_k")) * (cells + 3) + F.col("_ti") + F.col("_m"), "_w": F.col("_wx") * F.col("_wy")}) \
        .drop("_si", "_ti", "_bx", "_by", "_k", "_m", "_wx", "_wy")


def spline_levels(samples: DataFrame, measures: list[str], levels: int = 4, base: int = 4, px: str = "longitude", py: str = "latitude",
                  sid: str = "sensor_id") -> tuple[list[DataFrame], list[DataFrame], tuple[float, float, float, float], dict[str, float]]:
    """Multilevel B-spline approximation of scattered measures (Lee, Wolberg, Shin 1997).

    Level l has a lattice of ``base * 2**l`` cells a side over the samples'
    box.  Each sample offers its 16 nodes the value that would reproduce it
    with least effort; a node takes the mean of its offers weighted by the
    squared spline weights, one ``groupBy`` of sums.  The next level fits what
    is left.  Returns the lattices ``(_c, measures)``, the samples with what is
    left after each level, the box and the means that were taken off first.
    """
    spark = samples.sparkSession
    ensure_checkpoint_dir(spark)
    left = samples.select(sid, px, py, *[F.col(m).cast("double").alias(m) for m in measures]).where(F.col(px).isNotNull() & F.col(py).isNotNull())
    told = left.agg(F.min(px), F.max(px), F.min(py), F.max(py), *[F.avg(m) for m in measures]).first()
    extent, means = tuple(x or 0.0 for x in told[:4]), {m: x or 0.0 for m, x in zip(measures, told[4:])}
    left = left.select(sid, px, py, *[(F.col(m) - F.lit(means[m])).alias(m) for m in measures]).checkpoint(eager=True)
    lattices, rests = [], [left]
    for level in range(levels):
        near = _reached(left, px, py, extent, base * 2 ** level)
        w2 = F.col("_w") * F.col("_w")
        lattice = near.groupBy("_c").agg(*[F.try_divide(F.sum(w2 * F.col("_w") * F.col(m) / F.col("_all")), F.sum(F.when(F.col(m).isNotNull(), w2))).alias(m)
                                           for m in measures]).checkpoint(eager=True)
        fit = near.select(sid, "_c", "_w").join(lattice, "_c").groupBy(sid).agg(*[F.sum(F.col("_w") * F.col(m)).alias(f"_f_{m}") for m in measures])
        left = left.join(fit, sid, "left").select(sid, px, py, *[(F.col(m) - F.coalesce(f"_f_{m}", F.lit(0.0))).alias(m) for m in measures]) \
            .checkpoint(eager=True)
        lattices.append(lattice)
        rests.append(left)
    return lattices, rests, extent, means


def smooth_surface(points: DataFrame, samples: DataFrame, keys: list[str], measures: list[str], levels: int = 4, base: int = 4,
                   px: str = "mx", py: str = "my", carry: tuple[str, ...] = (), sid: str = "sensor_id") -> DataFrame:
    """Cubic (twice continuously differentiable) surface of the samples at the points: the levels' lattices of
    :func:`spline_levels`, summed (SP-7).  Points outside the samples' box get NULL."""
    lattices, _, extent, means = spline_levels(samples, measures, levels, base, sid=sid)
    x0, x1, y0, y1 = extent
    inside = points.where(F.col(px).between(x0, x1) & F.col(py).between(y0, y1)).select(*keys, px, py)
    parts = None
    for level, lattice in enumerate(lattices):
        near = _reached(inside, px, py, extent, base * 2 ** level).select(*keys, "_c", "_w")
        part = near.join(lattice, "_c").select(*keys, *[(F.col("_w") * F.col(m)).alias(m) for m in measures])
        parts = part if parts is None else parts.union(part)
    fit = parts.groupBy(*keys).agg(*[F.sum(m).alias(f"_f_{m}") for m in measures])
    within = F.col(px).between(x0, x1) & F.col(py).between(y0, y1)
    return points.join(fit, keys, "left").select(*keys, *carry, *[
        F.when(within, F.lit(means[m]) + F.coalesce(f"_f_{m}", F.lit(0.0))).alias(m) for m in measures])


def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str],
                     name: str = "pollutant", value: str = "value") -> DataFrame:
    """One row per (id, measure) (SP-8)."""
    return df.unpivot(ids, measures, name, value)


# ------------------------------------------------------------------ JN-8 nearest segment
def segment_cells(vertices: DataFrame, grid: H.HexGrid = H.FINE) -> DataFrame:
    """Segment vertices with their cell (SRC-9)."""
    return H.with_cell(vertices, "latitude", "longitude", "cell", grid)


def segment_cover(vertices: DataFrame, grid: H.HexGrid = H.FINE) -> DataFrame:
    """Distinct (cell, segment_id) that a segment's line passes (SRC-9).

    Every stretch between consecutive vertices is walked in steps of at most
    half a cell edge along each axis; the last vertex stands for itself.
    """
    w = Window.partitionBy("segment_id").orderBy("vseq")              # the vertices of one segment
    v = vertices.select("segment_id", "latitude", "longitude", F.lead("latitude").over(w).alias("_la"),
                        F.lead("longitude").over(w).alias("_lo"))
    dy, dx = F.col("_la") - F.col("latitude"), F.col("_lo") - F.col("longitude")
    n = F.greatest(F.ceil(F.greatest(F.abs(dy) * grid.ky, F.abs(dx) * grid.kx) / F.lit(grid.edge_m / 2.0)), F.lit(1)).cast("int")
    v = v.withColumn("_n", F.coalesce(n, F.lit(1))).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda c, to: F.coalesce(F.col(c) + (F.col(to) - F.col(c)) * F.col("_k") / F.col("_n"), F.col(c))
    steps = v.select("segment_id", at("latitude", "_la").alias("latitude"), at("longitude", "_lo").alias("longitude"))
    return H.with_cell(steps, "latitude", "longitude", "cell", grid).select("cell", "segment_id").distinct()


def _places(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per place (``keys``) with the smallest ``segment_id`` there (NULL if a row has none): of segments
    at one place no other can be the nearest."""
    whole = F.count("segment_id") == F.count(F.lit(1))
    return rows.groupBy(*keys).agg(F.when(whole, F.min("segment_id")).alias("segment_id"))


def segment_reach(vertices: DataFrame, max_ring: int = 4, grid: H.HexGrid = H.FINE) -> DataFrame:
    """For every cell within ``max_ring`` of the road network: the vertices of
    the segments that pass nearest to it (smallest ring), as one array per cell
    ``near`` of ``segment_id, x, y``, every place once.  Built from the segment
    table only, so its size is bounded by the network, not by the number of
    points snapped to it."""
    cover = segment_cover(vertices, grid)
    spots = vertices.select("segment_id", F.col("longitude").alias("x"), F.col("latitude").alias("y")).where("x is not null and y is not null")
    held = _places(cover.join(spots, "segment_id"), ["cell", "x", "y"])
    near = H.explode_disk(cover.select("cell").distinct(), max_ring, "cell", "target", "ring")
    first = F.min("ring").over(Window.partitionBy("target"))          # the cells around one cell
    near = near.withColumn("_r0", first).where(F.col("ring") == F.col("_r0")).select("target", "cell")
    near = _places(near.join(held, "cell"), ["target", "x", "y"])
    return near.groupBy(F.col("target").alias("cell")).agg(F.collect_list(F.struct("segment_id", "x", "y")).alias("near"))


# Candidates of a cell from which it is cut into boxes, and how often it may be halved (boxes of 0.7 m in FINE cells).
CROWDED = 16
MOST_CUTS = 6
# Slack of a box, as a part of its cell, for the rounding of coordinates.
BOX_SLACK = 1e-6


def _half_sides(grid: H.HexGrid) -> tuple[float, float]:
    """Half the width and height, in degrees, of the box around a cell."""
    return 0.5 * 3.0 ** 0.5 * grid.edge_m / grid.kx, grid.edge_m / grid.ky


def _cut_cells(crowded: DataFrame, ends: list[str], scale: tuple[float, float], grid: H.HexGrid) -> DataFrame:
    """Cells ``(cell, _cuts, cx, cy, near)`` cut into 2**cuts x 2**cuts boxes: ``(cell, box, near)`` with what can be nearest to a point of the box.

    Box by box halved: with D the distance of a candidate from the box's centre
    and r half the diagonal, a point of the box is between D - r and D + r away
    from it, so candidates beyond the smallest D + 2 r drop out.
    """
    (sx, sy), (hx, hy) = scale, _half_sides(grid)
    kind = crowded.schema["near"].dataType.elementType["segment_id"].dataType.simpleString()

    def away(px, py, line):
        x1, y1, x2, y2 = line
        ax, ay, dx, dy = (x2 - x1) * sx, (y2 - y1) * sy, (px - x1) * sx, (py - y1) * sy
        square = ax * ax + ay * ay
        t = np.clip(np.divide(dx * ax + dy * ay, square, out=np.zeros_like(square), where=square > 0), 0.0, 1.0)
        return np.hypot(dx - t * ax, dy - t * ay)

    def run(batches):
        for b in batches:
            for at in range(b.num_rows):
                cell, cuts, cx, cy = (b.column(c)[at].as_py() for c in ("cell", "_cuts", "cx", "cy"))
                near = b.column("near").slice(at, 1).flatten()
                parts = {n: near.field(n) for n in ["segment_id", *ends]}
                line = [parts[n].to_numpy(zero_copy_only=False) for n in (ends * 2)[:4]]
                pick = np.arange(len(near))
                ix, iy = np.zeros((2, len(near)), dtype=np.int64)
                for level in range(1, cuts + 1):
                    n = 1 << level
                    pick = np.repeat(pick, 4)
                    ix, iy = (np.repeat(2 * i, 4) + np.tile(step, len(i)) for i, step in ((ix, [0, 1, 0, 1]), (iy, [0, 0, 1, 1])))
                    far = away(cx + hx * ((2 * ix + 1) / n - 1), cy + hy * ((2 * iy + 1) / n - 1), [c[pick] for c in line])
                    r = np.hypot(hx * sx, hy * sy) * (1 / n + BOX_SLACK)
                    least = np.full(n * n, np.inf)
                    np.minimum.at(least, iy * n + ix, far)
                    stay = far <= (least[iy * n + ix] + 2 * r) * (1 + 1e-9)
                    pick, ix, iy = pick[stay], ix[stay], iy[stay]
                box = (iy << cuts) + ix
                order = np.argsort(box, kind="stable")
                boxes, starts = np.unique(box[order], return_index=True)
                held = pa.StructArray.from_arrays([c.take(pa.array(pick[order])) for c in parts.values()], names=list(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(boxes), cell)), pa.array(boxes), pa.ListArray.from_arrays(pa.array(np.r_[starts, len(pick)].astype(np.int32)), held)],
                    names=["cell", "box", "near"])

    inner = ", ".join([f"segment_id: {kind}", *[f"{c}: double" for c in ends]])
    return crowded.mapInArrow(run, f"cell bigint, box bigint, near array<struct<{inner}>>")


def _with_nearest(points: DataFrame, reach: DataFrame, ends: list[str], away, scale: tuple[float, float], grid: H.HexGrid) -> DataFrame:
    """Points with ``_m``, the smallest ``away(candidate)`` of their cell in ``reach`` (``cell, near``).

    Each point joins its own cell; where a cell has more than ``CROWDED``
    candidates, it joins its box in the cell instead, so that what a point looks
    at stays small however dense the network is.
    """
    n = F.size("near")
    cuts = F.when(n <= CROWDED, F.lit(0)).otherwise(F.least(F.ceil(F.log(4.0, n / 4.0)).cast("int"), F.lit(MOST_CUTS)))
    cells = reach.withColumn("_cuts", cuts)
    few = cells.select("cell", "_cuts", F.when(F.col("_cuts") == 0, F.col("near")).alias("_few"))
    cy, cx = H.cell_center("cell", grid)
    boxes = _cut_cells(cells.where("_cuts > 0").select("cell", "_cuts", cx.alias("cx"), cy.alias("cy"), "near"), ends, scale, grid) \
        .withColumnsRenamed({"near": "_many", "box": "_box"})
    hx, hy = _half_sides(grid)
    side = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_cuts"))        # boxes along each axis

    def part(c: str, middle: Column, half: float) -> Column:
        at = F.floor((F.col(c) - middle + F.lit(half)) / F.lit(2 * half) * side)
        return F.greatest(F.lit(0), F.least(at, side - 1))

    p = H.with_cell(points, "latitude", "longitude", "_cell", grid).withColumnRenamed("_cell", "cell").join(few, "cell", "left")
    box = part("latitude", cy, hy) * side + part("longitude", cx, hx)
    p = p.withColumn("_box", F.when(F.col("_cuts") > 0, box)).join(boxes, ["cell", "_box"], "left")
    return p.withColumn("_m", F.array_min(F.transform(F.coalesce("_few", "_many"), away)))


def snap_to_segment(points: DataFrame, vertices: DataFrame, max_ring: int = 4, grid: H.HexGrid = H.FINE) -> DataFrame:
    """Nearest road segment per point as ``segment`` and ``segment_dist``, NULL
    when none passes within ``max_ring`` cells (JN-8).

    Each point joins :func:`segment_reach` on its own cell (or its box in a
    crowded one), with all its columns; of the segments there the smallest
    (distance to a vertex, segment id) is taken by higher-order functions in a
    projection.
    """
    def nearest(s: Column) -> Column:
        return F.struct(S.euclid(s["x"], s["y"], F.col("longitude"), F.col("latitude")).alias("dist"), s["segment_id"].alias("segment_id"))

    best = _with_nearest(points, segment_reach(vertices, max_ring, grid), ["x", "y"], nearest, (1.0, 1.0), grid)
    return best.select(*points.columns, F.col("_m.segment_id").alias("segment"), F.col("_m.dist").alias("segment_dist"))


# ------------------------------------------------------------------ JN-8 nearest stretch
def segment_stretches(vertices: DataFrame) -> DataFrame:
    """The stretches between consecutive vertices: ``segment_id, x1, y1, x2, y2`` (degrees); a segment of one
    vertex is a stretch of no length."""
    w = Window.partitionBy("segment_id").orderBy("vseq")                  # the vertices of one segment
    v = vertices.select("segment_id", F.col("longitude").alias("x1"), F.col("latitude").alias("y1"),
                        F.lead("longitude").over(w).alias("x2"), F.lead("latitude").over(w).alias("y2"), F.lag("vseq").over(w).alias("_before"))
    return v.where("x2 is not null or _before is null").select("segment_id", "x1", "y1", F.coalesce("x2", "x1").alias("x2"), F.coalesce("y2", "y1").alias("y2"))


def stretch_reach(vertices: DataFrame, max_m: float, grid: H.HexGrid = H.FINE) -> DataFrame:
    """For every cell that holds a point within ``max_m`` metres of a stretch: the stretches in reach, every place once, as one array.

    A stretch is walked in steps of at most half a cell edge along each axis
    and put into the cells around its steps, so a cell holds what runs by it
    and nothing else of a long segment; the table grows with the length of the
    roads, not with its square.
    """
    st = segment_stretches(vertices)
    dx, dy = F.abs(F.col("x2") - F.col("x1")) * grid.kx, F.abs(F.col("y2") - F.col("y1")) * grid.ky
    n = F.greatest(F.ceil(F.greatest(dx, dy) / F.lit(grid.edge_m / 2.0)), F.lit(1)).cast("int")
    steps = st.withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    along = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("_k") / F.col("_n")
    steps = H.with_cell(steps.withColumns({"_y": along("y1", "y2"), "_x": along("x1", "x2")}), "_y", "_x", "cell", grid)
    ends = ["x1", "y1", "x2", "y2"]
    passed = _places(steps, ["cell", *ends])
    # centres of cells n rings apart are at least 1.5 n edges apart; point, step and stretch lie within 2.5 edges of theirs
    rings = int((max_m + 2.5 * grid.edge_m) / (1.5 * grid.edge_m))
    near = _places(H.explode_disk(passed, rings, "cell", "target", "ring"), ["target", *ends])
    return near.groupBy(F.col("target").alias("cell")).agg(F.collect_list(F.struct("segment_id", *ends)).alias("near"))


def snap_to_stretch(points: DataFrame, vertices: DataFrame, max_m: float = 50.0, grid: H.HexGrid = H.FINE) -> DataFrame:
    """Nearest road segment per point by its distance in metres to the line itself, as ``segment`` and ``segment_m``;
    NULL when no segment runs within ``max_m`` (JN-8, for segments whose vertices lie far apart).

    Each point joins :func:`stretch_reach` on its own cell (or its box in a crowded one); ties go to the smaller id.
    """
    def away(s: Column) -> Column:
        ax, ay = (s["x2"] - s["x1"]) * grid.kx, (s["y2"] - s["y1"]) * grid.ky
        px, py = (F.col("longitude") - s["x1"]) * grid.kx, (F.col("latitude") - s["y1"]) * grid.ky
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(px * ax + py * ay, ax * ax + ay * ay), F.lit(0.0))))
        return F.struct(F.sqrt((px - t * ax) * (px - t * ax) + (py - t * ay) * (py - t * ay)).alias("m"), s["segment_id"].alias("segment_id"))

    best = _with_nearest(points, stretch_reach(vertices, max_m, grid), ["x1", "y1", "x2", "y2"], away, (grid.kx, grid.ky), grid)
    hit = F.col("_m.m") <= max_m
    return best.select(*points.columns, F.when(hit, F.col("_m.segment_id")).alias("segment"), F.when(hit, F.col("_m.m")).alias("segment_m"))
