"""Keyed, time-partitioned tables as Spark DataFrames."""
