"""lendspark: default-risk analytics expressed as Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame``. Learned
operators split into ``fit`` (a small aggregate whose result is a bounded
parameter object) and ``apply`` (pure column expressions), so the same
parameters can be persisted and reused at scoring time.

Sub-packages:
  functions  column expressions: null handling, parsers, bin helpers
  operators  DataFrame operators: cleaning, targets, features, encoders,
             splits, joins, curves, metrics, banding, models
  sources    readers / writers and the fixture views over the test tables
  plans      user-facing pipelines and the driver query registry
"""

__version__ = "0.1.0"
