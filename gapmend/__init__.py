"""Keep a day-partitioned table complete against its source, on Spark.

Every operator is a function from DataFrame to DataFrame; jobs in
:mod:`gapmend.plans` put them together.
"""

__version__ = "0.1.0"
