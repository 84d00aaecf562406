"""bazaar: Spark-native marketplace analytics.

Every job is a function ``f(tables, **params) -> DataFrame`` over a catalog
``dict[str, DataFrame]`` keyed like the marketplace's CSV files (``orders``,
``order_items``, ``order_reviews``, ...).  Jobs only compose Spark SQL /
DataFrame / ``pyspark.ml`` built-ins, so Catalyst sees one lazy plan per job.
"""

__version__ = "0.1.0"
