"""feedlens: product-analytics operators for feed and messenger event data on Spark.

Every operator is a function from DataFrame(s) to a DataFrame.  Reference
dates are parameters (``as_of``, ``start``, ``end``); nothing reads the clock.
"""

__version__ = "0.1.0"
