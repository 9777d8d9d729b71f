"""tillroll — retail sales analytics expressed as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
Column for scalar helpers).  Nothing is collected to the driver; global
orderings, ranks and quantiles go through :mod:`tillroll.operators.ranking`,
which range-partitions instead of funnelling rows through a single task.
"""

__version__ = "0.1.0"
