"""lakeloom: declarative data tasks on Spark.

Named DataFrames in, named DataFrames out; every step is a Spark plan that runs
on executors. See ``lakeloom.catalog`` for the registered queries.
"""

__version__ = "0.1.0"
