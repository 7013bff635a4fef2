"""hebdo: weekly revenue analytics and forecasting as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function that works for any
number of series at once; ``keys`` names the columns that identify a series
(``[]`` means one global series).
"""

__version__ = "0.1.0"
