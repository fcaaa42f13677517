"""chatledger: chat exports -> sessions -> sales mart, on Spark.

Sub-packages:
  sources/    scans (chat CSV, JSON lines, driver tables, manifests)
  functions/  Column -> Column helpers (text cleaning, ids, money, labels)
  operators/  DataFrame -> DataFrame stages (messages, sessions, orders, mart, reports)
  plans/      input views over the driver tables and the query registry
  streaming/  Structured Streaming jobs (incremental ingest, sale dialogue)
"""

__version__ = "0.1.0"
