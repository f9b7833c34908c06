"""Layered trip-booking analytics on Spark DataFrames.

Raw booking files become typed Bronze tables, a Silver star schema and Gold
marts.  Operators take DataFrames and return DataFrames; only the warehouse
and the jobs read or write storage.
"""

__version__ = "0.1.0"
