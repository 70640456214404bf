"""Analytics for server authentication logs on Spark.

Everything is a ``DataFrame -> DataFrame`` function. The same parse, enrich
and aggregate functions serve batch tables and streams.
"""

__version__ = "0.1.0"
