"""The hex grid written as DuckDB SQL text, for oracles only."""

from __future__ import annotations

from citylens.functions.hexgrid import OFFSET, STRIDE, HexGrid


def lit(x: float) -> str:
    r = repr(float(x))
    return r if ("e" in r or "inf" in r or "nan" in r) else r + "e0"


def cell_sql(lat: str, lon: str, g: HexGrid) -> str:
    qf = f"({lon} * {lit(g.cqx)} - {lat} * {lit(g.cqy)})"
    rf = f"({lat} * {lit(g.cry)})"
    sf = f"(-{qf} - {rf})"
    rq, rr, rs = (f"floor({x} + 0.5)" for x in (qf, rf, sf))
    dq, dr, ds = (f"abs({a} - {b})" for a, b in ((rq, qf), (rr, rf), (rs, sf)))
    fix_q = f"({dq} > {dr} AND {dq} > {ds})"
    q = f"(CASE WHEN {fix_q} THEN -{rr} - {rs} ELSE {rq} END)"
    r = f"(CASE WHEN NOT {fix_q} AND NOT ({ds} > {dr}) THEN -{rq} - {rs} ELSE {rr} END)"
    return f"cast(({q} + {OFFSET}) * {STRIDE} + ({r} + {OFFSET}) AS bigint)"


def q_sql(cell: str) -> str:
    return f"(floor({cell} / {STRIDE}) - {OFFSET})"


def r_sql(cell: str) -> str:
    return f"(({cell} % {STRIDE}) - {OFFSET})"


def ring_text_sql(cell: str, g: HexGrid) -> str:
    """``[[lon, lat], ...]`` text of the closed boundary ring (6 decimals)."""
    q, r = q_sql(cell), r_sql(cell)
    lon = f"(({q} + {r} / 2e0) * {lit(g.clon)})"
    lat = f"({r} * {lit(g.clat)})"
    pts = []
    for dx, dy in g.corner_offsets():
        pts.append(f"printf('[%.6f, %.6f]', round({lon} + {lit(dx)}, 6), round({lat} + {lit(dy)}, 6))")
    pts.append(pts[0])
    return "('[' || " + " || ', ' || ".join(pts) + " || ']')"


def polygon_json_sql(cell: str, g: HexGrid) -> str:
    return ("('{\"type\": \"Polygon\", \"geometry\": {\"type\": \"Polygon\", \"coordinates\": [' || "
            + ring_text_sql(cell, g) + " || '] }}')")
