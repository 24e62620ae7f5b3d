"""Keyed-table replication and table-activity analytics on Spark DataFrames."""
