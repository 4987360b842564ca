"""Stand-in views over the generated test tables.

Each view is written once as dialect-neutral SQL with three macros:
``EPOCH(x)`` (``unix_timestamp(x)`` in Spark, ``cast(floor(epoch(x)) as
bigint)`` in DuckDB), ``SECONDS(x)`` (epoch seconds to a timestamp) and
``EACH(a, b)`` (one row per value).  Spark builds the views with ``spark.sql(text, table=DataFrame)`` so
no temp view names leak into the caller's session.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from citylens.session import use_utc

# The view definitions the test tables are read through.
VIEW_SQL: dict[str, str] = {
    "v_pings": """
select event_id as ping_id, user_id as trip_id, 'R' || cast(user_id % 12 as string) as route_id,
  case when event_id % 2 = 0 then 'UP' else 'DN' end as trip_direction,
  'V' || cast(user_id as string) as vehicle_label,
  'P' || cast(user_id % 40 as string) || '-' || cast(event_id % 2 as string) as license_plate,
  event_id % (user_id % 12 + 1) as last_stop_id, value as trip_delay, SECONDS(obs_epoch) as obs_ts, obs_epoch,
  1704067200 + (user_id % 24) * 3600 + (event_id % 5) * 60 as actual_start_epoch,
  21.1e0 + 0.004e0 * ((user_id * 7 + cast(floor((obs_epoch - 1704067200) / 259200e0) as bigint)) % 40) as latitude,
  72.7e0 + 0.004e0 * ((user_id * 11 + 3 * cast(floor((obs_epoch - 1704067200) / 259200e0) as bigint)) % 50) as longitude
from (select *, 1704067200 + cast(floor((EPOCH(ts) - 1704067200) * (user_id % 30 + 1) / 30e0) as bigint) as obs_epoch
  from {events}) e""",
    "v_schedule": """
select l_orderkey as trip_id, l_linenumber as stop_sequence, l_suppkey % 12 as stop_id,
  1704067200 + (l_linenumber - 1) * 432000 + (l_orderkey * 6151) % 86400 as arrival_epoch,
  1704067200 + (l_linenumber - 1) * 432000 + (l_orderkey * 6151) % 86400 + 60 as departure_epoch
from {lineitem}""",
    "v_routes": """
select p_partkey as point_id, 'R' || cast(p_partkey % 12 as string) as route_id,
  21.08e0 + 0.002e0 * ((p_partkey * 13) % 100) as latitude, 72.68e0 + 0.002e0 * ((p_partkey * 29) % 120) as longitude
from {part}""",
    "v_status_history": """
select o_orderkey as trip_id, case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'LATE' else 'LIVE' end as status,
  cast(o_orderdate as timestamp) as observe_ts
from {orders}""",
    "v_segment_vertices": """
select segment_id, vseq, 21.1e0 + 0.0016e0 * ((segment_id * 17) % 100) + 0.0005e0 * vseq as latitude,
  72.7e0 + 0.002e0 * ((segment_id * 31) % 100) + 0.001e0 * vseq as longitude, 300e0 + segment_id as length
from (select s_suppkey as segment_id, EACH(0, 1, 2) as vseq from {supplier}) v""",
    "v_sensors": """
select s_suppkey as sensor_id, 18.44e0 + 0.14e0 * ((s_suppkey * 61) % 103) / 103e0 as latitude,
  73.78e0 + 0.18e0 * ((s_suppkey * 37) % 101) / 101e0 as longitude
from {supplier}""",
    "v_readings": """
select l_suppkey as sensor_id, cast(l_shipdate as timestamp) as obs_ts, l_orderkey as k1, l_linenumber as k2, l_partkey as k3,
  l_quantity * 20e0 as co2, l_discount as co, l_tax as no2, l_extendedprice / 1000e0 as so2, l_quantity as pm10, l_quantity * 0.6e0 as pm2p5
from {lineitem}""",
    "v_timetable_json": """
select '{{"trip_id":"' || cast(l_orderkey as string) || '","trip_details":{{"stop_sequence":"' || cast(l_linenumber as string)
  || '","stop_id":"' || cast(l_suppkey as string) || '","arrival_time":"' || lpad(cast(5 + l_linenumber as string), 2, '0') || ':'
  || lpad(cast(l_orderkey % 60 as string), 2, '0') || ':00","departure_time":"' || lpad(cast(5 + l_linenumber as string), 2, '0') || ':'
  || lpad(cast(l_orderkey % 60 as string), 2, '0') || ':30"}}}}' as rec
from {lineitem}""",
    "v_incident_json": """
select '{{"resourceSets":[{{"resources":[{{"incidentId":' || cast(event_id as string) || ',"type":' || cast(event_id % 11 + 1 as string)
  || ',"severity":' || cast(event_id % 4 + 1 as string) || ',"roadClosed":' || case when event_id % 5 = 0 then 'true' else 'false' end
  || case when event_id % 3 = 0 then ',"title":"T' || cast(event_id % 7 as string) || '"' else '' end
  || ',"description":"D' || cast(event_id % 13 as string) || '","icon":"' || cast(event_id % 6 as string) || '","source":"'
  || cast(event_id % 9 as string) || '","verified":' || case when event_id % 4 = 0 then 'false' else 'true' end
  || ',"lastModified":"/Date(' || cast((EPOCH(ts) + 60) * 1000 as string) || ')/"'
  || ',"start":"/Date(' || cast(EPOCH(ts) * 1000 as string) || ')/","end":"/Date(' || cast((EPOCH(ts) + 3600) * 1000 as string)
  || ')/","point":{{"type":"Point","coordinates":[21.1,72.8]}},"toPoint":{{"type":"Point","coordinates":[21.2,72.9]}}}}]}}]}}' as rec
from {events}""",
    "v_region": """
select 0 as vseq, 21.08e0 as latitude, 72.68e0 as longitude union all select 1, 21.08e0, 72.92e0
union all select 2, 21.28e0, 72.92e0 union all select 3, 21.28e0, 72.68e0 union all select 4, 21.08e0, 72.68e0""",
}

_TABLE_REF = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")
_EPOCH = re.compile(r"EPOCH\((\w+)\)")
_SECONDS = re.compile(r"SECONDS\((\w+)\)")
_EACH = re.compile(r"EACH\(([^)]*)\)")


def tables_of(view: str) -> list[str]:
    return sorted(set(_TABLE_REF.findall(VIEW_SQL[view])))


def spark_text(view: str) -> str:
    text = _EPOCH.sub(r"unix_timestamp(\1)", VIEW_SQL[view])
    return _EACH.sub(r"explode(array(\1))", _SECONDS.sub(r"timestamp_seconds(\1)", text))


def duckdb_text(view: str) -> str:
    text = _EPOCH.sub(r"cast(floor(epoch(\1)) as bigint)", VIEW_SQL[view])
    text = _EACH.sub(r"unnest([\1])", _SECONDS.sub(r"make_timestamp(\1 * 1000000)", text))
    text = _TABLE_REF.sub(r"\1", text)
    return text.replace("{{", "{").replace("}}", "}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table; how it is split is the reader's business
    (``spark.sql.files.*``): a file of one row group is one task."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in view as a DataFrame (lazy; scans stay prunable)."""
    use_utc(spark)
    return spark.sql(spark_text(name), **{t: read_table(spark, sf_dir, t) for t in tables_of(name)})


def duckdb_with(*views: str) -> str:
    """``WITH`` prefix defining the given views for an oracle query."""
    parts = [f"{v} AS ({duckdb_text(v)}\n)" for v in views]
    return "WITH " + ",\n".join(parts) + "\n"
