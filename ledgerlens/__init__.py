"""ledgerlens: transaction-risk analytics as Spark DataFrame operators.

Layout:
  sources/    readers, writers and fixture adapters (CSV/JSON/parquet)
  functions/  column expressions (typing, ratios, flags, text assembly)
  operators/  DataFrame -> DataFrame operators (curation, profiling,
              features, splits, metrics, transformers, balancing, models)
  plans/      end-to-end flows composed from operators
  streaming/  Structured Streaming ingest and scoring
"""

__version__ = "0.1.0"
