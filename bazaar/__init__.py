"""bazaar: a PySpark analytics engine for item-marketplace data.

Sub-packages:
  functions  column expressions (casts, money, KPIs, display)
  sources    schema-checked readers, page scanners, the fixture adapter, sinks
  operators  keyed dedup, page extraction, marks, reshaping, search, data tests
  plans      the eight models, dashboard queries, incremental writer, daily run
  streaming  the incremental file-stream ingest
"""

__version__ = "0.1.0"
