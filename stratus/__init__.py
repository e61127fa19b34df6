"""stratus: Spark-native analytics for regularly sampled observation series.

Every public function is DataFrame -> DataFrame (or builds a pyspark.ml
pipeline); the heavy work runs as Spark joins, aggregations and windows.
"""

__version__ = "0.1.0"
