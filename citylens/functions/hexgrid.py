"""Planar hexagonal grid as pure column math (SP-1 .. SP-3).

A pointy-top hex grid on an equirectangular projection around a reference
latitude.  Cells are axial ``(q, r)`` pairs packed into one ``bigint`` so
that joins on cells are single-column equi-joins and neighbours are plain
integer offsets of the packed id.  All constants are folded on the driver
(``repr`` of a Python float parses to the same double in any engine).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
OFFSET = 1 << 21          # axial coordinates kept within +-2^21
STRIDE = 1 << 22          # packed id = (q + OFFSET) * STRIDE + (r + OFFSET)
NO_CELL = -1              # cell of a point without coordinates (valid ids are > 0)

# Edge lengths standing for the three resolutions used.
EDGE_COARSE_M = 460.0     # city cells (dwell, density, black spots)
EDGE_MEDIUM_M = 175.0     # air-quality cells
EDGE_FINE_M = 25.0        # road-segment snapping
DEFAULT_LAT0 = 21.0


@dataclass(frozen=True)
class HexGrid:
    edge_m: float = EDGE_COARSE_M
    lat0: float = DEFAULT_LAT0

    # metres per degree along each axis
    @property
    def kx(self) -> float:
        return EARTH_RADIUS_M * math.pi / 180.0 * math.cos(math.radians(self.lat0))

    @property
    def ky(self) -> float:
        return EARTH_RADIUS_M * math.pi / 180.0

    # fractional axial coordinates: qf = lon*cqx - lat*cqy ; rf = lat*cry
    @property
    def cqx(self) -> float:
        return self.kx * (math.sqrt(3.0) / 3.0) / self.edge_m

    @property
    def cqy(self) -> float:
        return self.ky / (3.0 * self.edge_m)

    @property
    def cry(self) -> float:
        return self.ky * 2.0 / (3.0 * self.edge_m)

    # cell centre: lon = (q + r/2) * clon ; lat = r * clat
    @property
    def clon(self) -> float:
        return self.edge_m * math.sqrt(3.0) / self.kx

    @property
    def clat(self) -> float:
        return 1.5 * self.edge_m / self.ky

    def corner_offsets(self) -> list[tuple[float, float]]:
        """(dlon, dlat) of the six corners, counter-clockwise from -30 deg."""
        out = []
        for i in range(6):
            a = math.radians(60.0 * i - 30.0)
            out.append((self.edge_m * math.cos(a) / self.kx, self.edge_m * math.sin(a) / self.ky))
        return out


COARSE = HexGrid(EDGE_COARSE_M)
MEDIUM = HexGrid(EDGE_MEDIUM_M, 18.5)
FINE = HexGrid(EDGE_FINE_M)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pack(q: Column, r: Column) -> Column:
    return ((q + F.lit(OFFSET)) * F.lit(STRIDE) + (r + F.lit(OFFSET))).cast("long")


def cell_q(cell) -> Column:
    return (F.floor(_c(cell) / F.lit(STRIDE)) - F.lit(OFFSET)).cast("long")


def cell_r(cell) -> Column:
    return (F.pmod(_c(cell), F.lit(STRIDE)) - F.lit(OFFSET)).cast("long")


def cell_center(cell, grid: HexGrid = COARSE) -> tuple[Column, Column]:
    """Packed cell -> (lat, lon) of its centre."""
    q, r = cell_q(cell), cell_r(cell)
    lon = (q + r / F.lit(2.0)) * F.lit(grid.clon)
    lat = r * F.lit(grid.clat)
    return lat, lon


# ---------------------------------------------------------------- staged DataFrame forms
# As one column expression the cell of a point is a large tree (the fractional
# coordinates are referenced many times).  The transforms below stage the
# computation over successive projections; Catalyst does not
# inline a non-trivial expression that is referenced more than once
# (CollapseProject), so each intermediate is computed once and generated
# code stays small.

def _sql_lit(x: float) -> str:
    r = repr(float(x))
    return r if ("e" in r or "inf" in r or "nan" in r) else r + "D"


def with_cell(df: DataFrame, lat: str, lon: str, out: str = "cell", grid: HexGrid = COARSE) -> DataFrame:
    """Add the packed cell of (lat, lon) as column ``out``.

    One Spark SQL statement with nested projections (a single analysis call
    instead of dozens of Column round trips).
    """
    keep = ", ".join(f"`{c}`" for c in df.columns if c != out)
    keep = keep + ", " if keep else ""
    la, lo = f"`{lat}`", f"`{lon}`"
    text = f"""
SELECT {keep}coalesce(((CASE WHEN _hfq THEN -_hrr - _hrs ELSE _hrq END) + {OFFSET}) * {STRIDE}
                      + ((CASE WHEN NOT _hfq AND NOT (_hds > _hdr) THEN -_hrq - _hrs ELSE _hrr END) + {OFFSET}),
                      CAST({NO_CELL} AS BIGINT)) AS `{out}`
FROM (SELECT *, (_hdq > _hdr) AND (_hdq > _hds) AS _hfq
      FROM (SELECT *, abs(_hrq - _hqf) AS _hdq, abs(_hrr - _hrf) AS _hdr, abs(_hrs - _hsf) AS _hds
            FROM (SELECT *, floor(_hqf + 0.5D) AS _hrq, floor(_hrf + 0.5D) AS _hrr, floor(_hsf + 0.5D) AS _hrs
                  FROM (SELECT *, -_hqf - _hrf AS _hsf
                        FROM (SELECT *, {lo} * {_sql_lit(grid.cqx)} - {la} * {_sql_lit(grid.cqy)} AS _hqf,
                                        {la} * {_sql_lit(grid.cry)} AS _hrf
                              FROM {{src}})))))"""
    # Non-nullable on purpose: a NULL-able key expression would make Catalyst
    # infer ``isnotnull(cell)`` for joins and push the whole expression into
    # the scan filter.  Points without coordinates share the NO_CELL id, the
    # same grouping a NULL key gets in an aggregate.
    return df.sparkSession.sql(text, src=df)


def with_boundary(df: DataFrame, cell: str = "cell", out: str = "ring", grid: HexGrid = COARSE,
                  digits: int = 6) -> DataFrame:
    """Add the closed boundary ring (array of [lon, lat]) of ``cell``; NULL for
    the cell of a point without coordinates."""
    cols = df.columns
    d = df.withColumns({"_bq": cell_q(cell), "_br": cell_r(cell)})
    d = d.withColumns({"_blon": (F.col("_bq") + F.col("_br") / F.lit(2.0)) * F.lit(grid.clon),
                       "_blat": F.col("_br") * F.lit(grid.clat)})
    pts = [F.array(F.round(F.col("_blon") + F.lit(dx), digits), F.round(F.col("_blat") + F.lit(dy), digits))
           for dx, dy in grid.corner_offsets()]
    ring = F.when(F.col(cell) != F.lit(NO_CELL), F.array(*pts, pts[0]))
    return d.select(*[F.col(c) for c in cols if c != out], ring.alias(out))


def explode_disk(df: DataFrame, k: int, cell: str = "cell", out: str = "nb", ring: str = "ring") -> DataFrame:
    """One row per cell of the filled k-disk around ``cell`` (SP-3).

    Two ``sequence`` generators over axial offsets; the row count per input
    row is fixed by ``k`` (3k(k+1)+1).
    """
    cols = df.columns
    d = df.select("*", F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("_dq"))
    lo = F.greatest(F.lit(-k), -F.col("_dq") - F.lit(k))
    hi = F.least(F.lit(k), -F.col("_dq") + F.lit(k))
    d = d.select("*", F.explode(F.sequence(lo, hi)).alias("_dr"))
    nb = F.col(cell) + F.col("_dq").cast("long") * F.lit(STRIDE) + F.col("_dr").cast("long")
    rg = F.greatest(F.abs("_dq"), F.abs("_dr"), F.abs(F.col("_dq") + F.col("_dr")))
    return d.select(*[F.col(c) for c in cols], nb.alias(out), rg.alias(ring))
