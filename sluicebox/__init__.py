"""Layered refinement of bank-transaction events on Spark DataFrames.

Raw event records land unchanged in a bronze layer; a narrow plan parses, types,
masks and scores them; clean rows wash into silver and the rest into garbage.
"""

__version__ = "0.1.0"
