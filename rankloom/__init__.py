"""rankloom — behaviour-log recommendation analytics as Spark DataFrame jobs.

Layers:
  sources/    typed readers: driver tables, fixture logs, rating-matrix files
  functions/  column expressions (fixed event weights, epoch millis, hash buckets, dot products)
  operators/  DataFrame -> DataFrame building blocks (prep, matrices, profiles, splits)
  plans/      composed flows: ALS training, scoring, top-N, tuning, metrics
"""

__version__ = "0.1.0"
