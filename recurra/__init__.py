"""recurra — recurring-revenue analytics on Spark DataFrames.

Layout:
  functions/  Column-expression helpers (rounding, tenure, month math, safe division)
  sources/    schemas, readers, sinks, and the test-table bindings
  operators/  the analytics operators (revenue, churn, cohorts, quality, measures, ...)
  plans/      query registry and the DuckDB oracle SQL used for correctness checks
  streaming/  Structured Streaming variants of the incremental KPIs
"""

__version__ = "0.1.0"
