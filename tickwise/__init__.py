"""tickwise: daily market-data analytics expressed as Spark DataFrame plans.

Operators take and return lazy DataFrames; jobs write tables. Rows are never
collected to the driver: only lists bounded by the calendar or by a batch of
files, and small statistics (README, "Fault tolerance").
"""

from tickwise.params import Params, DEFAULT_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS"]
