"""Compare Spark result types with DuckDB oracle types for every key."""

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

MAP = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
       "BooleanType()": "BOOLEAN", "FloatType()": "FLOAT", "ShortType()": "SMALLINT", "ByteType()": "TINYINT",
       "DateType()": "DATE", "TimestampType()": "TIMESTAMP WITH TIME ZONE", "TimestampNTZType()": "TIMESTAMP"}


def main():
    sf = "/root/testdata/sf0.001"
    from citylens.catalog import ORACLES, QUERIES
    from citylens.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in ["supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    keys = sys.argv[1:] or sorted(QUERIES)
    for key in keys:
        df = QUERIES[key](spark, sf)
        s = {f.name: MAP.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        rel = con.sql(ORACLES[key])
        d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        bad = {c: (s[c], d.get(c)) for c in s if s[c] != d.get(c)}
        if bad:
            print("TYPE", key, bad)
    print("done")


if __name__ == "__main__":
    main()
