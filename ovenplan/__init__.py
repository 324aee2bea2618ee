"""ovenplan: daily demand analytics and next-day production planning on Spark.

Functions take and return DataFrames; none holds a session. Sub-packages:
``sources`` (scans, landing, payloads, sinks), ``operators`` (rollup,
dimension, calendar, weather, series windows, reports, evaluation,
forecast), ``functions`` (column expressions), ``models`` (Spark ML),
``streaming`` (incremental ingest) and ``plans`` (registered queries and
their SQL oracles).
"""

__version__ = "0.1.0"
