"""Area products: zero-filled ping density, air-quality surface (P-11, P-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.functions.timeutil import observe_time_micros
from citylens.operators import spatial as SP
from citylens.operators.aggregates import count_by
from citylens.operators.clean import drop_null_rows
from citylens.operators.sets import zero_fill
from citylens.operators.windows import latest_per_key, surrogate_key
from citylens.session import ensure_checkpoint_dir
from citylens.sources.scans import scan_window


def region_cells(region: DataFrame, grid: H.HexGrid = H.COARSE) -> DataFrame:
    """Cells of all regions given as ring vertices (vseq, latitude, longitude, and
    region_id and ring_id if there is more than one ring), as ``read_region`` gives them."""
    v = region
    if "region_id" not in v.columns:
        v = v.withColumn("region_id", F.lit(0))
    if "ring_id" not in v.columns:
        v = v.withColumn("ring_id", F.lit(0))
    return SP.polyfill(v, grid).select("cell").distinct()


def ping_density_map(pings: DataFrame, region: DataFrame, as_of: int, days: int | None = 30,
                     grid: H.HexGrid = H.COARSE, offset_minutes: int = 330) -> DataFrame:
    """P-11: pings per cell over the trailing days, 0 for region cells without pings."""
    window = (as_of - days * 86400, as_of) if days else (None, None)
    p = drop_null_rows(scan_window(pings, "obs_epoch", *window).select(
        "ping_id", "trip_id", "route_id", "license_plate", "obs_epoch", "latitude", "longitude"))
    counts = count_by(H.with_cell(p, "latitude", "longitude", "cell", grid).select("cell"), ["cell"])
    filled = H.with_boundary(zero_fill(counts, region_cells(region, grid), ["cell"], "count"), "cell", "ring", grid)
    return filled.select(
        "cell", F.col("count").cast("int").alias("count"),
        S.polygon_json("ring").alias("coordinates"),
        observe_time_micros(as_of, offset_minutes).alias("observationDateTime"),
    )


# Lower bound per pollutant of the interpolated surface.
POLLUTANT_FLOORS = {"co2": 200.0, "co": 0.0, "no2": 0.0, "so2": 0.0, "pm10": 0.0, "pm2p5": 0.0}


def latest_readings(readings: DataFrame, order=("obs_ts", "k1", "k2", "k3")) -> DataFrame:
    """Newest complete reading per sensor (PRJ-3, W-2)."""
    return latest_per_key(drop_null_rows(readings), ["sensor_id"], list(order))


def air_quality_surface(readings: DataFrame, sensors: DataFrame, as_of: int, res: int = 100,
                        floors: dict | None = None, nearest: int = 8, power: float = 2.0,
                        grid: H.HexGrid = H.MEDIUM, offset_minutes: int = 330,
                        order=("obs_ts", "k1", "k2", "k3"), levels: int | None = None) -> DataFrame:
    """P-12: interpolated pollutant values on a res x res mesh.

    newest reading per sensor -> join coordinates -> mesh over the sensors'
    box -> points inside the hull of all sensors -> inverse-distance weights of
    each point's ``nearest`` sensors (or, with ``levels``, a smooth cubic surface
    of that many spline levels) -> one row per pollutant -> floor clamp ->
    cell polygon per point.
    """
    floors = floors or POLLUTANT_FLOORS
    measures = list(floors.keys())
    ensure_checkpoint_dir(readings.sparkSession)
    latest = latest_readings(readings, order)
    # one row per sensor: small by nature, materialised once so the uses
    # below (box, hull, neighbours) do not rescan the readings
    located = latest.join(sensors.select("sensor_id", "latitude", "longitude"), "sensor_id") \
        .select("sensor_id", "latitude", "longitude", *measures).checkpoint(eager=True)
    m = SP.in_hull(SP.mesh(located, res), SP.convex_hull(located))
    if levels:
        wide = SP.smooth_surface(m, located, ["i", "j"], measures, levels, carry=("mx", "my"))
    else:
        pairs = SP.nearest_sensors(m, located, nearest, ["i", "j"], carry=measures)
        wide = SP.idw(pairs, ["i", "j"], measures, power, carry=("mx", "my"))
    z = SP.unpivot_measures(wide, ["i", "j", "mx", "my"], measures)
    fl = F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(float(v)))])
    z = z.withColumn("weight", S.clamp_floor("value", fl[F.col("pollutant")]))
    z = H.with_boundary(H.with_cell(z, "my", "mx", "cell", grid), "cell", "ring", grid)
    # Fixed value: the reference's own spelling of the polygon column.
    return z.select(
        "pollutant", "i", "j", "weight",
        S.polygon_json("ring").alias("coodinates"),
        surrogate_key("pollutant", "i", "j", F.lit(int(as_of))).alias("primary_key"),
        observe_time_micros(as_of, offset_minutes).alias("observationDateTime"),
    )
