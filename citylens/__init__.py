"""citylens: Spark-native analytics for city sensor data.

Transit GPS pings, timetables, road incidents and air-quality readings are
turned into trip-status, dwell, delay, coverage and surface products using
only DataFrame / SQL operators (joins, aggregates, windows, native column
expressions) so that Catalyst plans and executors do the heavy work.
"""

__all__ = ["session"]
