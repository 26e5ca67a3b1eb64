"""sparkmart: Spark-native loading, repair, extraction and classification jobs
for retail / TV-shopping catalogue tables.

Every operator is a function from DataFrames (plus small parameters) to a
DataFrame, built only from Spark SQL expressions, joins, aggregates and
windows so Catalyst can prune, push down and plan the whole job.
"""

__version__ = "0.1.0"
