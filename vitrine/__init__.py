"""vitrine: a Spark-native library for trustworthy ingestion, reconciliation and
archiving of machine inspection logs.

Sub-packages:
  functions  column expressions (cleaning, keys, calendar helpers)
  sources    file listing and header-mapped log readers
  operators  DataFrame -> DataFrame operators (sequence, merge, reconcile, archive, watermark)
  plans      end-to-end jobs (ingest, audit, archive) and the query catalog
  streaming  Structured Streaming drivers for the same operators
"""

__version__ = "0.1.0"
