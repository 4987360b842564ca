"""Registry of runnable queries (one per inventory key) and their SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the stand-in views of
the generated tables; each oracle is DuckDB SQL computing the same rows
independently (views inlined as CTEs).
"""

from citylens.catalog.registry import ORACLES, QUERIES, register  # noqa: F401
from citylens.catalog import (  # noqa: F401  (modules register on import)
    q_trips,
    q_basic,
    q_spatial,
    q_products,
    q_ingest,
    q_stream,
    q_chains,
    q_incremental,
)
