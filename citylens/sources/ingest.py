"""Landed-file readers and nested-record flattening (SRC-5 .. SRC-8).

Records arrive as JSON text (one record per row, as landed from the feeds);
parsing uses ``from_json`` with a declared schema, never a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylens.functions import scalar as S
from citylens.functions.timeutil import date_text, service_ts
from citylens.session import scratch_path

TIMETABLE_SCHEMA = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("trip_details", T.StructType([
        T.StructField("stop_sequence", T.StringType()),
        T.StructField("stop_id", T.StringType()),
        T.StructField("arrival_time", T.StringType()),
        T.StructField("departure_time", T.StringType()),
    ])),
])

_POINT = T.StructType([T.StructField("type", T.StringType()),
                       T.StructField("coordinates", T.ArrayType(T.DoubleType()))])

INCIDENT_SCHEMA = T.StructType([T.StructField("resourceSets", T.ArrayType(T.StructType([
    T.StructField("resources", T.ArrayType(T.StructType([
        T.StructField("point", _POINT),
        T.StructField("toPoint", _POINT),
        T.StructField("description", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("icon", T.StringType()),
        T.StructField("incidentId", T.LongType()),
        T.StructField("isEndTimeBackfilled", T.BooleanType()),
        T.StructField("lastModified", T.StringType()),
        T.StructField("roadClosed", T.BooleanType()),
        T.StructField("severity", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("verified", T.BooleanType()),
    ]))),
])))])


def flatten_timetable(records: DataFrame, service_date: str, rec: str = "rec") -> DataFrame:
    """Timetable JSON records -> typed stop rows with epoch-µs times (SRC-5, SC-11).

    Clock texts are prefixed with the service date and parsed in the
    session time zone; ids are cast leniently (malformed -> NULL).
    """
    r = records.select(F.from_json(F.col(rec), TIMETABLE_SCHEMA).alias("r"))
    d = r.select("r.trip_id", "r.trip_details.*")
    micros = lambda c: F.unix_micros(service_ts(F.lit(service_date), c))
    return d.select(
        F.col("trip_id").try_cast("int").alias("trip_id"),
        F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        F.col("stop_id").try_cast("int").alias("stop_id"),
        micros("arrival_time").alias("arrival_time"),
        micros("departure_time").alias("departure_time"),
    )


def flatten_incidents(payloads: DataFrame, offset_minutes: int = 330, rec: str = "rec") -> DataFrame:
    """Incident payloads -> one row per resource of the first result set (SRC-6);
    a resource keeps its row whatever fields it lacks.

    ``/Date(ms)/`` texts become epoch µs shifted by ``offset_minutes``;
    a missing title becomes ''; the type code is decoded to its label.
    """
    shift = offset_minutes * 60 * 1_000_000
    r = payloads.select(F.from_json(F.col(rec), INCIDENT_SCHEMA).alias("p"))
    res = r.select(F.inline(F.get(F.col("p.resourceSets"), 0)["resources"]))
    at = lambda c: S.parse_epoch_text(F.col(c)) + F.lit(shift)
    return res.select(
        F.get(F.col("point.coordinates"), 0).alias("latitude"),
        F.get(F.col("point.coordinates"), 1).alias("longitude"),
        "description",
        at("end").alias("end"),
        F.col("icon").try_cast("int").alias("icon"),
        "incidentId",
        "isEndTimeBackfilled",
        at("lastModified").alias("lastModified"),
        "roadClosed",
        F.col("severity").try_cast("int").alias("severity"),
        F.col("source").try_cast("int").alias("source"),
        at("start").alias("start"),
        S.fill_missing_text("title").alias("title"),
        F.get(F.col("toPoint.coordinates"), 0).alias("toPoint_latitude"),
        F.get(F.col("toPoint.coordinates"), 1).alias("toPoint_longitude"),
        F.col("type").try_cast("int").alias("type_int"),
        S.decode(F.col("type")).alias("type_string"),
        "verified",
    )


SENSOR_SCHEMA = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("address", T.StringType()),
])


def read_sensors(spark: SparkSession, path: str, schema: T.StructType = SENSOR_SCHEMA) -> DataFrame:
    """Sensor coordinate CSV with a header and quoted, comma-bearing addresses (SRC-7).

    Columns are taken by position (sensor_id, longitude, latitude, address): the
    id column is named as the surface (P-12) expects it."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', mode="PERMISSIVE")


REGION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),        # raw JSON: its depth depends on the type
        ])),
    ]))),
])
_POLYGON = "array<array<array<double>>>"


def read_region(spark: SparkSession, path: str, id_property: str = "id", multi_line: bool = True,
                id_col: str = "region_id") -> DataFrame:
    """GeoJSON polygons and multipolygons -> one row per ring vertex (SRC-8).

    Columns: ``id_col`` (``properties[id_property]``, else the feature's
    number), ring_id (unique per file, feature, polygon and ring), vseq,
    latitude, longitude; GeoJSON positions are [lon, lat].  Other geometry
    types fail.  ``multi_line`` reads one pretty-printed document per file;
    ``False`` reads JSON lines.
    """
    fc = spark.read.schema(REGION_SCHEMA).option("multiLine", multi_line).json(path)
    f = fc.select(F.monotonically_increasing_id().alias("doc"), F.posexplode("features").alias("fid", "f"))
    g = F.col("f.geometry")
    parts = (F.when(g["type"] == "Polygon", F.array(F.from_json(g["coordinates"], _POLYGON)))
             .when(g["type"] == "MultiPolygon", F.from_json(g["coordinates"], f"array<{_POLYGON}>"))
             .when(g.isNotNull(), F.raise_error(F.concat(F.lit("no polygon geometry: "), F.coalesce(g["type"], F.lit("none"))))))
    polygons = f.select("doc", "fid", F.coalesce(F.col("f.properties")[id_property], F.col("fid").cast("string")).alias(id_col),
                        F.posexplode(parts).alias("pid", "polygon"))
    rings = polygons.select("doc", "fid", "pid", id_col, F.posexplode("polygon").alias("rid", "ring"))
    v = rings.select(id_col, F.concat_ws("-", "doc", "fid", "pid", "rid").alias("ring_id"),
                     F.posexplode("ring").alias("vseq", "pt"))
    return v.select(id_col, "ring_id", "vseq", F.col("pt")[1].alias("latitude"), F.col("pt")[0].alias("longitude"))


def write_geojson_rings(spark: SparkSession, vertices: DataFrame, key: str, id_property: str = "id") -> str:
    """Write one GeoJSON FeatureCollection per key (``id`` property) to a fresh
    folder under the shared checkpoint location; returns the folder."""
    pts = F.array_sort(F.collect_list(F.struct("vseq", "longitude", "latitude")))
    g = vertices.groupBy(key).agg(pts.alias("_v"))
    feat = g.select(F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.array(F.struct(
            F.create_map(F.lit(id_property), F.col(key).cast("string")).alias("properties"),
            F.struct(F.lit("Polygon").alias("type"),
                     F.array(F.transform("_v", lambda p: F.array(p["longitude"], p["latitude"])))
                     .alias("coordinates")).alias("geometry"))).alias("features")).alias("fc"))
    path = scratch_path(spark, "regions")
    feat.select(F.to_json("fc").alias("value")).write.mode("overwrite").text(path)
    return path


def write_sensor_csv(spark: SparkSession, sensors: DataFrame) -> str:
    """Write sensors as a headered CSV with quoted addresses; returns the folder."""
    path = scratch_path(spark, "sensors")
    sensors.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)
    return path


def timetable_service_date(as_of: int) -> str:
    return date_text(as_of)
