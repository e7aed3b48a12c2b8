"""tillpoint — retail point-of-sale analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function over a sales-line
DataFrame with a fixed column contract (see :mod:`tillpoint.schemas`), so the
same code runs on a real sales sheet and on the driver's TPC-H-like tables.
"""

__version__ = "0.1.0"
