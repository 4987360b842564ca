"""Print the formatted physical plan of each product (or the given keys).

Usage: python tools/explain_products.py [sf_dir] [key ...]
AQE may still change join strategies and partition counts at run time.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bench import PRODUCTS  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in args if not a.startswith("/")] or PRODUCTS
    from citylens.catalog import QUERIES
    from citylens.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for key in keys:
        df = QUERIES[key](spark, sf)
        print(f"===== {key}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
