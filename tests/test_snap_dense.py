"""Snapping where a cell has many segments: the same nearest one, few candidates looked at."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.operators import spatial as SP

VERTICES = "segment_id long, vseq int, latitude double, longitude double, length double"
POINTS = "id long, latitude double, longitude double"


def dense(rng, n):
    """Short segments within about one cell, each at its own place, and points among them."""
    at = lambda: (21.1 + rng.uniform(-2e-4, 2e-4), 72.8 + rng.uniform(-2e-4, 2e-4))
    lines = [[at() for _ in range(1 + i % 3)] for i in range(n)]
    return lines, [at() for _ in range(300)]


def tables(spark, lines, spots):
    vertices = spark.createDataFrame([(s, k, la, lo, 1.0) for s, line in enumerate(lines) for k, (la, lo) in enumerate(line)], VERTICES)
    return vertices, spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], POINTS)


def candidates(reach, ends, scale, grid=H.FINE):
    """Candidates of the boxes that a cell is cut into, at most."""
    cy, cx = H.cell_center("cell", grid)
    cells = reach.select("cell", F.lit(4).alias("_cuts"), cx.alias("cx"), cy.alias("cy"), "near")
    return SP._cut_cells(cells, ends, scale, grid).select(F.max(F.size("near"))).first()[0]


def test_nearest_vertex_among_many(spark):
    lines, spots = dense(random.Random(3), 900)
    vertices, pts = tables(spark, lines, spots)
    got = {r.id: (r.segment, r.segment_dist) for r in SP.snap_to_segment(pts, vertices, 12).collect()}
    reach = SP.segment_reach(vertices, 12)
    assert reach.select(F.max(F.size("near"))).first()[0] > 300 and candidates(reach, ["x", "y"], (1.0, 1.0)) < 250
    cells = {r.id: r.cell for r in H.with_cell(pts, "latitude", "longitude", "cell", H.FINE).collect()}
    held = {r.cell: {s.segment_id for s in r.near} for r in reach.collect()}
    for i, (la, lo) in enumerate(spots):
        # all vertices of the segments that pass nearest to the cell
        best = min((math.sqrt((x - lo) ** 2 + (y - la) ** 2), s) for s in held[cells[i]] for y, x in lines[s])
        assert got[i][0] == best[1] and abs(got[i][1] - best[0]) < 1e-12, i


def test_nearest_line_among_many(spark):
    lines, spots = dense(random.Random(4), 600)
    vertices, pts = tables(spark, lines, spots)
    g = H.FINE
    got = {r.id: (r.segment, r.segment_m) for r in SP.snap_to_stretch(pts, vertices, 30.0).collect()}
    reach = SP.stretch_reach(vertices, 30.0)
    assert reach.select(F.max(F.size("near"))).first()[0] > 500 and candidates(reach, ["x1", "y1", "x2", "y2"], (g.kx, g.ky)) < 200

    def away(px, py, a, b):
        ax, ay, dx, dy = (b[1] - a[1]) * g.kx, (b[0] - a[0]) * g.ky, (px - a[1]) * g.kx, (py - a[0]) * g.ky
        t = max(0.0, min(1.0, (dx * ax + dy * ay) / (ax * ax + ay * ay))) if ax or ay else 0.0
        return math.hypot(dx - t * ax, dy - t * ay)

    for i, (la, lo) in enumerate(spots):
        want = min((min(away(lo, la, a, b) for a, b in zip(v, v[1:] or v)), s) for s, v in enumerate(lines))
        assert (got[i][0], pytest.approx(want[0], abs=1e-6)) == (want[1] if want[0] <= 30 else None, got[i][1]), i


def test_segments_at_one_place_count_once(spark):
    lines = [[(21.1, 72.8), (21.1005, 72.801)]] * 400
    vertices, pts = tables(spark, lines, [(21.10001, 72.80001), (21.1005, 72.801)])
    assert SP.segment_reach(vertices).select(F.max(F.size("near"))).first()[0] == 2
    assert SP.stretch_reach(vertices, 50.0).select(F.max(F.size("near"))).first()[0] == 1
    assert {r.segment for r in SP.snap_to_segment(pts, vertices).collect()} == {0}
    assert {r.segment for r in SP.snap_to_stretch(pts, vertices).collect()} == {0}
