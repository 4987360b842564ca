"""Hand-made frames for branches and edge rows."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.functions import hexgrid as H
from citylens.functions import scalar as S
from citylens.operators import spatial as SP
from citylens.operators import windows as W
from citylens.plans import quality as Q
from citylens.plans import trips as P
from citylens.sources import ingest as I

PING_SCHEMA = ("ping_id long, trip_id long, route_id string, trip_direction string, vehicle_label string, "
               "license_plate string, last_stop_id long, trip_delay double, obs_epoch long, latitude double, "
               "longitude double")
SCH_SCHEMA = "trip_id long, stop_sequence int, stop_id long, arrival_epoch long, departure_epoch long"


def test_classify_trip_branches(spark):
    rows = [  # percent, first, last, start, end
        ("live", 0.5, 0, 10, 0, 100),          # span 0.1 <= 0.6
        ("incomplete", 0.5, 0, 90, 0, 100),    # span 0.9
        ("completed", 0.8, 0, 100, 0, 100),
        ("late_end", 0.8, 0, 5000, 0, 100),
        ("late_start", 0.1, 4000, 4001, 0, 0),  # zero-length timetable: NULL span, start late
        ("missed", 0.1, 0, 1, 0, 0),           # NULL span, not late
    ]
    df = spark.createDataFrame(rows, "name string, p double, f long, l long, s long, e long")
    got = dict(df.select("name", S.classify_trip("p", "f", "l", "s", "e")).collect())
    assert got == {"live": "LIVE", "incomplete": "INCOMPLETE", "completed": "COMPLETED",
                   "late_end": "LATE", "late_start": "LATE", "missed": "MISSED"}


def test_classify_unstarted(spark):
    rows = [("before", 200, 300), ("inside", 50, 300), ("after", 10, 20),
            ("one_stop", 160, 100)]          # departure after arrival: start > end
    df = spark.createDataFrame(rows, "name string, s long, e long")
    got = dict(df.select("name", S.classify_unstarted(F.lit(None).cast("string"), "s", "e", 100)).collect())
    assert got == {"before": "NOT STARTED", "inside": "NOT STARTED", "after": "MISSED", "one_stop": "NOT STARTED"}


def test_traffic_category_and_fault_flag(spark):
    df = spark.createDataFrame([(0,), (59,), (60,), (179,), (299,), (599,), (600,), (None,)], "d int")
    cats = [r[0] for r in df.select(S.traffic_category("d")).collect()]
    assert cats[:7] == [1, 1, 2, 2, 3, 4, 5]
    flags = [r[0] for r in df.select(S.fault_flag("d", 110)).collect()]
    assert flags == [0, 0, 0, 1, 1, 1, 1, 1]


def test_minmax_bucket_equal_weights(spark):
    df = spark.createDataFrame([(3,), (3,)], "w int")
    assert [r[0] for r in df.select(S.minmax_bucket("w", F.lit(3), F.lit(3))).collect()] == [1, 1]
    df = spark.createDataFrame([(1,), (5,), (3,)], "w int")
    assert sorted(r[0] for r in df.select(S.minmax_bucket("w", F.lit(1), F.lit(5))).collect()) == [1, 3, 5]


def test_drop_latest_single_row_group_vanishes(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 5)], "id long, k string, t long")
    assert sorted(r.id for r in W.drop_latest(df, ["k"], ["t", "id"]).collect()) == [1]


def test_bucketed_gap_equals_plain_lag(spark):
    rows = [(i, i % 3, (i * 7919) % 500000) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, t long")
    a = {r.id: r.gap for r in W.gap_seconds(df, ["k"], "t", "id", bucket_s=3600).collect()}
    b = {r.id: r.gap for r in W.gap_seconds(df, ["k"], "t", "id", bucket_s=None).collect()}
    assert a == b


def test_trip_status_edges(spark):
    pings = spark.createDataFrame([
        (1, 10, "R1", "UP", "V10", "P1", 1, 5.0, 1000, 21.1, 72.8),
        (2, 10, "R1", "UP", "V10", "P2", 2, 7.0, 2000, 21.2, 72.7),   # two plates on one trip
    ], PING_SCHEMA)
    sch = spark.createDataFrame([
        (10, 1, 1, 900, 960), (10, 2, 2, 2100, 2160),
        (20, 1, 5, 5000, 5060),                                         # one-stop trip, start > end
        (30, 1, 6, 100, 160), (30, 2, 7, 200, 260),                     # not started, already over
    ], SCH_SCHEMA)
    out = {(r.trip_id, r.license_plate): r for r in P.trip_status(pings, sch, 3000).collect()}
    assert out[("10", "P1")].status == out[("10", "P2")].status == "COMPLETED"
    assert out[("20", None)].status == "NOT STARTED"
    assert out[("30", None)].status == "MISSED"
    assert out[("10", "P1")].latitude == 21.2 and out[("10", "P1")].longitude == 72.7


def test_empty_window_gives_no_started_trips(spark):
    pings = spark.createDataFrame([], PING_SCHEMA)
    sch = spark.createDataFrame([(1, 1, 1, 10, 70)], SCH_SCHEMA)
    rows = P.trip_status(pings, sch, 0).collect()
    assert [(r.trip_id, r.status) for r in rows] == [("1", "NOT STARTED")]


def test_hex_cell_roundtrip_and_neighbours(spark):
    pts = spark.createDataFrame([(21.0 + i * 0.0037, 72.5 + i * 0.0041) for i in range(50)], "lat double, lon double")
    c = H.with_cell(pts, "lat", "lon", "cell", H.COARSE)
    lat, lon = H.cell_center("cell", H.COARSE)
    back = H.with_cell(c.select("cell", lat.alias("clat"), lon.alias("clon")), "clat", "clon", "again", H.COARSE)
    assert back.where("cell != again").count() == 0
    d = SP.disk(c.select("cell").distinct().limit(1), 2)
    assert d.count() == 19 and d.where("ring = 1").count() == 6


def test_null_coordinates_get_no_cell_sentinel(spark):
    pts = spark.createDataFrame([(None, 72.0), (21.0, 72.0)], "lat double, lon double")
    cells = [r.cell for r in H.with_cell(pts, "lat", "lon", "cell").collect()]
    assert cells[0] == H.NO_CELL and cells[1] > 0


def test_polyfill_square_area(spark):
    # a ~10 km square holds about area / cell area cells
    ring = [(0, 21.0, 72.5), (1, 21.0, 72.6), (2, 21.09, 72.6), (3, 21.09, 72.5), (4, 21.0, 72.5)]
    v = spark.createDataFrame(ring, "vseq int, latitude double, longitude double").withColumn(
        "region_id", F.lit(1)).withColumn("ring_id", F.lit(0))
    n = SP.polyfill(v, H.COARSE).count()
    g = H.COARSE
    area = (0.1 * g.kx) * (0.09 * g.ky)
    cell_area = 1.5 * math.sqrt(3) * g.edge_m ** 2
    assert abs(n - area / cell_area) / (area / cell_area) < 0.05


SENSORS = "sensor_id long, latitude double, longitude double"
POINTS = "i int, j int, mx double, my double"


def test_sensor_on_grid_point_and_collinear(spark):
    sensors = spark.createDataFrame([(1, 18.5, 73.8), (2, 18.6, 73.9), (3, 18.5, 73.9)], SENSORS)
    pts = spark.createDataFrame([(0, 0, 73.8, 18.5), (1, 1, 73.89, 18.51), (2, 2, 73.81, 18.59)], POINTS)
    inside = {(r.i, r.j) for r in SP.in_hull(pts, SP.convex_hull(sensors)).collect()}
    assert inside == {(0, 0), (1, 1)}            # on a sensor; inside the triangle; (2, 2) outside
    valued = sensors.withColumn("value", F.col("sensor_id") * 10.0)
    pairs = SP.nearest_sensors(pts, valued, 8, ["i", "j"], carry=["value"])
    z = {(r.i, r.j): r.value for r in SP.idw(pairs, ["i", "j"], ["value"]).collect()}
    assert z[(0, 0)] == 10.0 and len(z) == 3
    line = spark.createDataFrame([(1, 18.5, 73.8), (2, 18.6, 73.9), (3, 18.7, 74.0)], SENSORS)
    off = spark.createDataFrame([(0, 0, 73.9, 18.5), (1, 0, 73.9, 18.6)], POINTS)
    assert [(r.i, r.j) for r in SP.in_hull(off, SP.convex_hull(line)).collect()] == [(1, 0)]
    assert SP.convex_hull(line.where("false")).count() == 0


def test_wide_network_keeps_all_mesh_points(spark):
    corners = spark.createDataFrame([(1, 18.0, 73.0), (2, 18.0, 77.0), (3, 22.0, 73.0), (4, 22.0, 77.0)], SENSORS)
    grid = SP.in_hull(SP.mesh(corners, 21), SP.convex_hull(corners))
    assert grid.count() == 441
    assert SP.nearest_sensors(grid, corners, 8, ["i", "j"]).count() == 441 * 4


def test_nearest_sensors_equal_brute_force(spark):
    import random
    rng = random.Random(2)
    far = [(i, rng.gauss(18.5, 0.01), rng.gauss(73.9, 0.01)) for i in range(300)] + [(1000, 25.0, 80.0), (1001, 18.5, 90.0)]
    far += [(2000 + i, 18.5, 73.9) for i in range(20)]                       # co-located sensors tie by id
    pts = [(i, j, 73.5 + j * 0.9, 18.0 + i * 0.4) for i in range(18) for j in range(18)]
    got = {}
    for r in SP.nearest_sensors(spark.createDataFrame(pts, POINTS), spark.createDataFrame(far, SENSORS), 5, ["i", "j"]).collect():
        got.setdefault((r.i, r.j), set()).add(r.sensor_id)
    for i, j, x, y in pts:
        want = sorted((math.sqrt((x - lo) ** 2 + (y - la) ** 2), s) for s, la, lo in far)[:5]
        assert got[i, j] == {s for _, s in want}


def test_ping_on_no_segment_and_mid_segment(spark):
    verts = spark.createDataFrame([(1, 0, 21.1, 72.7, 300.0), (1, 1, 21.1005, 72.701, 300.0),
                                   (2, 0, 21.2, 72.7, 300.0), (2, 1, 21.2, 72.72, 300.0)],
                                  "segment_id long, vseq int, latitude double, longitude double, length double")
    pts = spark.createDataFrame([(1, 21.1001, 72.7001), (2, 21.3, 72.9), (3, 21.2001, 72.71), (4, None, 72.7)],
                                "ping_id long, latitude double, longitude double")
    got = {r.ping_id: r.segment for r in SP.snap_to_segment(pts, verts).collect()}
    assert got == {1: 1, 2: None, 3: 2, 4: None}


def test_repeated_status_rows_do_not_duplicate_pings(spark):
    pings = spark.createDataFrame([
        (1, 10, "R1", "UP", "V10", "P1", 1, 5.0, 1000, 21.1, 72.8),
        (2, 10, "R1", "UP", "V10", "P1", 1, 5.0, 1050, 21.1, 72.8),
    ], PING_SCHEMA)
    hist = spark.createDataFrame([(10, "COMPLETED", 0), (10, "COMPLETED", 1)], "trip_id long, status string, t long") \
        .withColumn("observe_ts", F.timestamp_seconds("t"))
    r = Q.faulty_trackers(pings, hist, 2000, limit=110).collect()[0]
    assert (r.not_faulty_count, r.faulty_count, r.is_faulty) == (1, 1, False)


def test_incident_without_title_and_malformed_id(spark):
    recs = ['{"resourceSets":[{"resources":[{"incidentId":7,"type":2,"severity":"x","start":"/Date(1000)/",'
            '"end":"/Date(2000)/","point":{"coordinates":[21.1,72.8]},"toPoint":{"coordinates":[21.2,72.9]}}]}]}']
    df = spark.createDataFrame([(r,) for r in recs], "rec string")
    r = I.flatten_incidents(df, 0).collect()[0]
    assert r.title == "" and r.severity is None and r.type_string == "Congestion"
    assert r.start == 1_000_000 and r.end == 2_000_000


def test_timetable_malformed_ids(spark):
    recs = ['{"trip_id":"12a","trip_details":{"stop_sequence":"1","stop_id":"5","arrival_time":"06:00:00",'
            '"departure_time":"06:00:30"}}']
    df = spark.createDataFrame([(r,) for r in recs], "rec string")
    r = I.flatten_timetable(df, "2024-01-16").collect()[0]
    assert r.trip_id is None and r.stop_id == 5
    assert r.arrival_time == (1705363200 + 6 * 3600) * 1_000_000


def test_trip_status_job_writes_six_outputs(spark):
    from citylens.session import scratch_path
    from citylens.sources.fixtures import view
    sf = "/root/testdata/sf0.001"
    out = scratch_path(spark, "job")
    live, sch = view(spark, sf, "v_pings"), view(spark, sf, "v_schedule")
    th = P.TripThresholds(late_s=432000)
    paths = P.trip_status_job(live, sch, 1705363200, out, thresholds=th, recent_minutes=10 * 24 * 60)
    assert len(paths) == 6
    n_status = P.trip_status(live, sch, 1705363200, thresholds=th).count()
    assert spark.read.parquet(paths["trip_status_live"]).count() == n_status
    # a rerun the same day replaces the daily rows instead of duplicating them
    P.trip_status_job(live, sch, 1705363200 + 900, out, thresholds=th)
    assert spark.read.parquet(paths["trip_status_live"]).count() == n_status


def test_stream_latest_matches_batch_and_restarts(spark):
    from citylens.session import scratch_path
    from citylens.plans.surface import latest_readings
    from citylens.sources.fixtures import view
    from citylens.streaming import streams as ST
    sf = "/root/testdata/sf0.001"
    base = scratch_path(spark, "latest-test")
    src = ST.stream_view(spark, sf, "v_readings").na.drop()
    order = ["obs_ts", "k1", "k2", "k3"]
    assert ST.stream_latest(src, ["sensor_id"], order, path=base) == base
    got = {r.sensor_id: (r.k1, r.k2, r.k3) for r in ST.read_latest(spark, base, src.schema).collect()}
    want = {r.sensor_id: (r.k1, r.k2, r.k3) for r in latest_readings(view(spark, sf, "v_readings")).collect()}
    assert got == want
    # restart on the same checkpoint: nothing new, nothing rewritten
    again = ST.stream_latest(ST.stream_view(spark, sf, "v_readings").na.drop(), ["sensor_id"], order, path=base)
    assert again is None


def test_scan_window_prunes_date_partitions(spark):
    from citylens.session import scratch_path
    from citylens.sources.scans import scan_window
    from citylens.sources.sinks import append_history
    path = scratch_path(spark, "pruning")
    day = 86400
    rows = spark.createDataFrame([(i, 1705363200 + i * 3600) for i in range(72)], "id long, obs_epoch long")
    for d in range(3):
        part = rows.where((F.col("obs_epoch") >= 1705363200 + d * day) & (F.col("obs_epoch") < 1705363200 + (d + 1) * day))
        append_history(part, path, 1705363200 + d * day)
    back = spark.read.parquet(path)
    got = scan_window(back, "obs_epoch", 1705363200 + day, 1705363200 + 2 * day - 1, partition_col="run_date")
    assert got.count() == 24
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_stream_equals_batch_on_final_windows(spark):
    """ST-1 over a file stream equals the same operator over the batch view,
    restricted to windows the end watermark has closed."""
    from citylens.sources.fixtures import view
    from citylens.streaming import streams as ST
    sf = "/root/testdata/sf0.001"
    delay = 2 * 86400
    path = ST.run_available_now(ST.stream_dwell(ST.stream_view(spark, sf, "v_pings"), f"{delay} seconds", "1 day"),
                                "dwell-test")
    streamed = {tuple(r) for r in spark.read.parquet(path).collect()}
    batch_src = view(spark, sf, "v_pings")
    wm = batch_src.agg(F.max("obs_epoch")).first()[0] - delay
    batch = ST.stream_dwell(batch_src, f"{delay} seconds", "1 day").where(F.col("window_end") <= wm)
    assert streamed == {tuple(r) for r in batch.collect()}
    assert streamed


def test_panel_lags_pivot(spark):
    from citylens.plans.dwell import panel_lags
    rows = [(7, "UP", s, float(s)) for s in range(4)] + [(7, "DN", s, -1.0) for s in range(4)]
    panel = spark.createDataFrame(rows, "cell long, trip_direction string, slot int, mean_dwell double")
    got = {r.trip_direction: (r.lag_0, r.lag_3) for r in panel_lags(panel).collect()}
    assert got == {"UP": (0.0, 3.0), "DN": (-1.0, -1.0)}


def test_join_back_keeps_null_keys_like_a_window(spark):
    df = spark.createDataFrame([(1, None, 10), (2, None, 30), (3, "a", 5)], "id long, k string, t long")
    got = {r.id: r.dwell_time for r in W.span_over(df, ["k"], "t").collect()}
    assert got == {1: 20, 2: 20, 3: 0}
    assert sorted(r.id for r in W.drop_latest(df, ["k"], ["t", "id"]).collect()) == [1]


def test_stream_latest_merges_batches_and_fails_on_an_unreadable_version(spark, tmp_path):
    import os
    import pytest
    from citylens.streaming import streams as ST
    src, base = str(tmp_path / "src"), str(tmp_path / "latest")
    schema = "k long, t long, x string"

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        return ST.stream_latest(spark.readStream.schema(schema).parquet(src), ["k"], ["t"], path=base)

    feed([(1, 1, "a"), (2, 5, "b")])
    feed([(2, 3, "old"), (3, 1, "c")])
    stored = ST.read_latest(spark, base, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, stored.collect())) == [(1, 1, "a"), (2, 5, "b"), (3, 1, "c")]
    for d, _, files in os.walk(base):
        for f in files:
            if f.endswith(".parquet"):
                with open(f"{d}/{f}", "wb") as broken:
                    broken.write(b"not parquet")
                crc = f"{d}/.{f}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
    with pytest.raises(Exception):
        feed([(1, 9, "z"), (2, 9, "z"), (3, 9, "z")])


def test_status_job_replaces_a_trip_that_changed(spark, tmp_path):
    sch = spark.createDataFrame([(1, 1, 1, 1705365000, 1705365060), (1, 2, 2, 1705369000, 1705369060)], SCH_SCHEMA)
    none = spark.createDataFrame([], PING_SCHEMA)
    one = spark.createDataFrame([(1, 1, "R1", "UP", "V1", "P1", 1, 5.0, 1705365100, 21.1, 72.8),
                                 (2, 1, "R1", "UP", "V1", "OLD", 1, 900.0, 1705365100 - 5 * 86400, 21.1, 72.8)], PING_SCHEMA)
    out = str(tmp_path / "job")
    P.trip_status_job(none, sch, 1705363260, out)
    paths = P.trip_status_job(one, sch, 1705366980, out, live_window=(1705363200, 1705366980))
    daily = spark.read.parquet(paths["trip_status_live"]).collect()
    assert [(r.trip_id, r.status, r.license_plate) for r in daily] == [("1", "LIVE", "P1")]
    delays = spark.read.parquet(paths["live_trip_with_delay"]).collect()
    assert [(r.license_plate, r.trip_delay) for r in delays] == [("P1", 5.0)]


def test_checkpoint_dir_must_be_set_on_a_cluster():
    import pytest
    from citylens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_incident_without_id_and_point_keeps_its_row(spark):
    df = spark.createDataFrame([('{"resourceSets":[{"resources":[{"title":"x"},{"incidentId":1}]}]}',), ('{"resourceSets":[]}',)], "rec string")
    assert sorted((r.title, r.incidentId) for r in I.flatten_incidents(df).collect()) == [("", 1), ("x", None)]


def test_region_of_another_geometry_fails(spark, tmp_path):
    import pytest
    path = str(tmp_path / "r.json")
    with open(path, "w") as f:
        f.write('{"type":"FeatureCollection","features":[{"properties":{},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    with pytest.raises(Exception, match="no polygon geometry"):
        I.read_region(spark, path).collect()


def _town(n=4000):
    import random
    rng = random.Random(7)
    town = [(i, 18.5 + rng.random() * 0.01, 73.8 + rng.random() * 0.01) for i in range(n)]
    return town + [(n, 25.0, 80.2)] + [(n + 1 + i, 18.505, 73.805) for i in range(40)]


def test_tree_leaves_hold_at_most_their_bound(spark):
    town = _town()
    placed, levels = SP.sensor_tree(spark.createDataFrame(town, SENSORS), leaf=8, fanout=4)
    sizes = [r["count"] for r in placed.groupBy("node").count().collect()]
    assert max(sizes) == 8 and sum(sizes) == len(town) and len(sizes) == -(-len(town) // 8)
    for below, above in zip(levels, levels[1:]):
        n = {r.node: r.n for r in above.collect()}
        held = {}
        for r in below.collect():
            held[r.node // 4] = held.get(r.node // 4, 0) + r.n
        assert held == n
    assert levels[-1].count() <= SP.TOP


def test_nearest_in_a_town_and_far_away_look_at_few_sensors(spark):
    town = _town()
    pts = [(i, j, 73.79 + j * 0.002, 18.49 + i * 0.002) for i in range(15) for j in range(15)] + [(99, 0, 77.0, 21.0), (99, 1, 80.2, 25.0)]
    sensors, points = spark.createDataFrame(town, SENSORS), spark.createDataFrame(pts, POINTS)
    got = {}
    for r in SP.nearest_sensors(points, sensors, 5, ["i", "j"]).collect():
        got.setdefault((r.i, r.j), set()).add(r.sensor_id)
    for i, j, x, y in pts:
        assert got[i, j] == {s for _, s in sorted((math.sqrt((x - lo) ** 2 + (y - la) ** 2), s) for s, la, lo in town)[:5]}


def test_spline_error_falls_with_each_level(spark):
    import random
    rng = random.Random(3)
    xy = [(i, rng.random(), rng.random()) for i in range(150)]
    sensors = spark.createDataFrame([(i, y, x, math.sin(5 * x) * math.cos(4 * y), None if i % 10 == 0 else 7.0) for i, x, y in xy],
                                    "sensor_id long, latitude double, longitude double, z double, flat double")
    _, rests, _, means = SP.spline_levels(sensors, ["z", "flat"], levels=5)
    errors = [r.agg(F.max(F.abs("z"))).first()[0] for r in rests]
    assert all(b < a for a, b in zip(errors, errors[1:])) and errors[-1] < 0.1 * errors[0]
    assert means["flat"] == 7.0 and rests[-1].agg(F.max(F.abs("flat"))).first()[0] == 0


def test_smooth_surface_has_no_cusp_at_sensors(spark):
    sensors = spark.createDataFrame([(k, 0.25 * i, 0.25 * j, float((i - 2) ** 2 + (j - 2) ** 2)) for k, (i, j) in enumerate((i, j) for i in range(5) for j in range(5))],
                                    "sensor_id long, latitude double, longitude double, z double")
    h = 1e-3
    pts = spark.createDataFrame([(0, d, 0.5 + (d - 1) * h, 0.5) for d in range(3)] + [(1, 0, 1.5, 0.5), (2, 0, 0.0, 0.0)], POINTS)
    z = {(r.i, r.j): r.z for r in SP.smooth_surface(pts, sensors, ["i", "j"], ["z"], levels=4).collect()}
    slopes = (z[0, 1] - z[0, 0]) / h, (z[0, 2] - z[0, 1]) / h
    assert abs(slopes[0] - slopes[1]) < 2.0                    # one slope from both sides (a cone or a cusp turns its sign)
    assert abs(z[0, 1]) < 0.2 and abs(z[2, 0] - 8.0) < 0.5 and z[1, 0] is None
    assert SP.smooth_surface(pts.where("false"), sensors, ["i", "j"], ["z"]).count() == 0


def test_text_ids_order_like_numbers_of_one_length(spark):
    from citylens.plans.dwell import cell_dwell_rows
    from citylens.plans.segments import segment_dwell
    rows = [(100 + i, 1 + i % 2, "R1", "UP", "V1", "P1", 1, 5.0, 1705365100 + (i // 3), 21.1, 72.8) for i in range(30)]
    pings = spark.createDataFrame(rows, PING_SCHEMA)
    text = pings.withColumn("ping_id", F.concat(F.lit("m-"), F.col("ping_id").cast("string")))
    got = [{str(r.ping_id).removeprefix("m-") for r in cell_dwell_rows(p).collect()} for p in (pings, text)]
    assert got[0] == got[1] and len(got[0]) == 28
    segments = spark.createDataFrame([(7, 300.0, [[72.8, 21.1]])], "segment_id long, length double, coords array<array<double>>")
    told = [sorted(map(str, segment_dwell(p.withColumn("segment", F.lit(7)), segments).collect())) for p in (pings, text)]
    assert told[0] == told[1] and len(told[0]) == 2


def test_long_segment_is_clipped_to_the_cells_it_passes(spark):
    import random
    rng = random.Random(5)
    g = H.FINE
    line, x, y = [], 72.8, 21.1
    for i in range(10_000):                                   # a road of 10,000 vertices that winds and comes back
        line.append((1, i, y, x))
        x, y = x + 2e-5 * math.cos(i / 900), y + 2e-5 * math.sin(i / 900)
    line += [(2, 0, 21.1, 72.8), (2, 1, 21.13, 72.84), (3, 0, 21.105, 72.803)]      # far vertices; one vertex only
    vertices = spark.createDataFrame(line, "segment_id long, vseq int, latitude double, longitude double")
    reach = SP.stretch_reach(vertices, 40.0)
    widest = reach.select(F.max(F.size("near"))).first()[0]
    assert widest < 400                                       # of 10,001 stretches
    pts = [(i, y + rng.uniform(-8e-4, 8e-4), x + rng.uniform(-8e-4, 8e-4)) for i, (_, _, y, x) in enumerate(rng.sample(line, 60))]
    pts += [(100 + i, 21.1 + 0.03 * t, 72.8 + 0.04 * t + 1e-4) for i, t in enumerate((0.13, 0.5, 0.77))] + [(200, 21.105, 72.8031), (201, 25.0, 70.0)]
    got = {r.id: (r.segment, r.segment_m) for r in SP.snap_to_stretch(
        spark.createDataFrame(pts, "id long, latitude double, longitude double"), vertices, 40.0).collect()}
    by = {}
    for s, _, la, lo in line:
        by.setdefault(s, []).append((lo * g.kx, la * g.ky))

    def away(px, py, a, b):
        ax, ay = b[0] - a[0], b[1] - a[1]
        t = max(0.0, min(1.0, ((px - a[0]) * ax + (py - a[1]) * ay) / (ax * ax + ay * ay))) if ax or ay else 0.0
        return math.hypot(px - a[0] - t * ax, py - a[1] - t * ay)

    for i, la, lo in pts:
        want = min((min(away(lo * g.kx, la * g.ky, a, b) for a, b in zip(v, v[1:] or v)), s) for s, v in by.items())
        if want[0] <= 40.0:
            assert got[i][0] == want[1] and abs(got[i][1] - want[0]) < 1e-5, i
        else:
            assert got[i] == (None, None), i
    assert any(s == 2 for s, _ in got.values()) and got[200][0] in (1, 2, 3) and got[201] == (None, None)


def test_hot_group_passes_as_batches(spark):
    from citylens.operators import udf as U
    import pyarrow as pa

    def widest_batch(batches):
        sizes = [b.num_rows for b in batches]
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(sizes)], pa.int64()), "widest": pa.array([max(sizes)], pa.int64()),
                                          "batches": pa.array([len(sizes)], pa.int64())})

    rows = spark.range(150_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 100_003).alias("v"))
    got = U.apply_grouped_stream(rows, ["k"], widest_batch, "n long, widest long, batches long").collect()
    assert sum(r.n for r in got) == 150_000 and max(r.n for r in got) == 50_000
    assert max(r.widest for r in got) <= 10_000 and max(r.batches for r in got) >= 5

    def falls(batches):
        last, down = None, 0
        for b in batches:
            for v in b.column("v").to_pylist():
                down += last is not None and v < last
                last = v
        yield pa.RecordBatch.from_pydict({"down": pa.array([down], pa.int64())})

    assert {r.down for r in U.apply_grouped_stream(rows, ["k"], falls, "down long", ["v"]).collect()} == {0}


def test_learned_weights_find_the_rule(spark):
    import random
    from citylens.plans import dwell as D
    rng = random.Random(1)
    x = [[rng.random() for _ in range(4)] + [1.0] for _ in range(2000)]
    rows = spark.createDataFrame([(*v, 0.4 * v[3] - 0.1 * v[0] + 0.05) for v in x], "x0 double, x1 double, x2 double, x3 double, x4 double, y double")
    weights, intercept = D.learned_weights(D.fit_lag_weights(rows, 4, ridge=0.0))
    assert all(abs(a - b) < 1e-9 for a, b in zip((*weights, intercept), (-0.1, 0, 0, 0.4, 0.05)))
    assert D.learned_weights(D.fit_lag_weights(rows.where("false"))) == ((0.0,) * 4, 0.0)
