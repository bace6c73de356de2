"""rankflow: periodic-ranking analytics on Spark DataFrames.

Every public operator is a ``DataFrame -> DataFrame`` function built from the
Spark DataFrame / SQL API; Catalyst plans them, nothing runs on the driver.
"""

__version__ = "0.1.0"
