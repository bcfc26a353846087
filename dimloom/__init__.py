"""dimloom: clean a wide event table and load an audited star schema with Spark.

Every operator is a function from DataFrames to DataFrames built from
``pyspark.sql.functions`` expressions, joins, aggregations and windows, so
Catalyst plans the whole chain and nothing row-at-a-time runs in Python.
"""

from dimloom.session import get_spark, scratch_root

__all__ = ["get_spark", "scratch_root"]
