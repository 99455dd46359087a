"""tickweave: market-tick landing, bars, reconciliation and reference data on Spark.

Every operator is a function from DataFrame(s) to DataFrame, built from Spark
SQL / DataFrame / Structured Streaming primitives so that Catalyst plans it and
the work spreads over the cluster.
"""

__version__ = "0.1.0"
