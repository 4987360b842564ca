"""Structural checks on the physical plans (scale properties, not values)."""

import re

import pytest

from citylens.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PRODUCTS = ["trip_status", "trip_delay_by_status", "trip_deviation_by_status", "scheduled_terminals",
            "cell_delay", "cell_dwell_model", "cell_dwell_forecast", "segment_traffic", "network_black_spots",
            "faulty_trackers", "ping_density_map", "air_quality_surface", "timetable_load", "incident_load"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PRODUCTS)
def test_products_have_no_pair_products(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_trip_status_aggregates_before_shuffling(spark):
    plan = _plan(QUERIES["trip_status"](spark, SF))
    # both big inputs go through a partial aggregate before their hash exchange
    assert len(re.findall(r"partial_min\(departure_epoch", plan)) == 1
    assert len(re.findall(r"partial_min\(obs_epoch", plan)) == 1
    assert "Window [" not in plan


def _nodes(node):
    yield node
    kids = node.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def test_snap_does_not_explode_points(spark):
    from citylens.operators.spatial import snap_to_segment
    from citylens.sources.fixtures import view
    pings = view(spark, SF, "v_pings").select("ping_id", "latitude", "longitude")
    root = snap_to_segment(pings, view(spark, SF, "v_segment_vertices"))._jdf.queryExecution().optimizedPlan()
    generates = [n for n in _nodes(root) if n.nodeName() == "Generate"]
    assert generates                                   # the disk explode exists ...
    for g in generates:                                # ... but only over the segment table
        scans = [n.toString() for n in _nodes(g) if n.nodeName() == "LogicalRelation"]
        assert scans and all("s_suppkey" in t and "event_id" not in t for t in scans)


def test_range_scan_prunes_columns(spark):
    df = QUERIES["scan_window_closed"](spark, SF)
    plan = _plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"event_id", "ts", "user_id"}


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, value in old.items():
        spark.conf.set(k, value) if value is not None else spark.conf.unset(k)


def _physical(df):
    return [n for n in _nodes(df._jdf.queryExecution().sparkPlan()) if n]


def _ping_exchanges(spark, key):
    """Hash exchanges of the executed plan right above rows of events that no aggregate has combined."""
    plan = _plan(QUERIES[key](spark, SF)).splitlines()
    found = 0
    for at, line in enumerate(plan):
        if "Exchange hashpartitioning" not in line:
            continue
        depth = line.index("Exchange")
        for below in plan[at + 1:]:
            if below.find(below.strip(" :+-*()0123456789")[:1]) <= depth - 3:
                break
            if "Aggregate" in below or "WindowGroupLimit" in below or "Exchange" in below:
                break
            if "FileScan" in below:
                found += "event_id" in below or "user_id" in below
                break
    return found


@pytest.mark.parametrize("key", ["win_lag_gap", "segment_traffic"])
def test_pings_shuffle_once(spark, no_broadcast, key):
    assert _ping_exchanges(spark, key) == 1


# the pings of completed trips still meet the status table by trip; by cell only distinct cells shuffle
@pytest.mark.parametrize("key, raw", [("join_left_anti_cells", 1), ("set_difference_cells", 0), ("join_left_anti_from_null", 0)])
def test_right_sides_combine_before_they_shuffle(spark, no_broadcast, key, raw):
    assert _ping_exchanges(spark, key) == raw


def test_delay_scans_at_most_three_tables(spark, no_broadcast):
    assert _plan(QUERIES["trip_delay_by_status"](spark, SF)).count("FileScan") <= 3


def test_no_pairs_of_all_points_and_sensors(spark):
    from citylens.operators.spatial import mesh, nearest_sensors
    sensors = spark.range(2000).selectExpr("id as sensor_id", "18 + (id * 61 % 103) / 103 as latitude", "73 + (id * 37 % 101) / 101 as longitude")
    pairs = nearest_sensors(mesh(sensors, 40), sensors, 4, ["i", "j"])
    assert pairs.count() == 40 * 40 * 4


@pytest.mark.parametrize("key", ["win_latest_per_key", "agg_dedup_subset", "win_drop_latest", "cell_dwell_model", "agg_segment_dwell"])
def test_no_sort_aggregate_of_raw_rows(spark, key):
    plan = _plan(QUERIES[key](spark, SF)).splitlines()
    for at, line in enumerate(plan):
        if "SortAggregate" in line and "partial_" in line:
            assert not any("FileScan" in x for x in plan[at + 1:at + 5]), line
