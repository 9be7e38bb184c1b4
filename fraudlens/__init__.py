"""fraudlens: rare-event (fraud) analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` (or ``DataFrame -> report
DataFrame``) function built from Spark SQL expressions, windows, joins and
``pyspark.ml`` so that Catalyst plans it and executors run it.
"""

__version__ = "0.1.0"
