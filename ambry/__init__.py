"""ambry — incremental warehouse loading and product scoring on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL API so that Catalyst and AQE plan the physical work.
"""

__version__ = "0.1.0"
