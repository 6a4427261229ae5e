"""Transit demand and disruption analytics on Spark DataFrames.

Every operator takes DataFrames and parameters and returns a DataFrame; nothing
reads a clock (``as_of`` is always given) and nothing collects rows.
"""

__version__ = "0.1.0"
