"""loomstat: machine-learning analytics on tables and text, written for Spark.

Every operator takes and returns DataFrames, or is a Spark ML estimator.  The
work is declared with the DataFrame API, so that Catalyst plans it and the
cluster partitions it; only results whose size does not grow with the rows
(column statistics, d x d matrices, model weights) ever reach the driver.
"""

__version__ = "0.1.0"
