"""ptloom: post-training dataset engine on Spark.

Every public operator takes DataFrames (and plain keyword parameters) and
returns a DataFrame.  The heavy lifting is Spark SQL expressions, joins,
aggregates and windows; nothing is collected to the driver except
size-bounded summaries (histograms of at most a few tens of thousands rows).
"""

__version__ = "0.1.0"
