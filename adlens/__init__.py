"""adlens: Spark-native jobs for advertising events and product reviews.

Every operator is a plain function over DataFrames (``DataFrame -> DataFrame``),
built from Spark's own joins, aggregates, windows, higher-order functions and
Structured Streaming. No Python UDF runs in any query path.
"""

__version__ = "0.1.0"
