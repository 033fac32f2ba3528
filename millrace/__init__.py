"""Data contracts, profiling, gold modelling and bounded metrics over Spark DataFrames.

Every function takes and returns DataFrames and stays lazy, except the few that
publish a table, halt a load or drive a stream; those say so in their docstring.
"""

__version__ = "0.1.0"
