"""tessera — tabular and panel analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers / writers with explicit schemas (S1-S15)
  functions  Column builders: scalar, text, calendar, geo (P*, F*)
  operators  DataFrame -> DataFrame operators: aggregates, windows, joins,
             set ops, ordering, quality, prep, validation, metrics,
             selection, models, ensembles
  plans      registered queries over the driver tables + DuckDB oracles
  streaming  Structured Streaming adapters for the batch operators
"""

__all__ = ["session"]
