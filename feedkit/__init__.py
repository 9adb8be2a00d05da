"""feedkit: Spark-native operators for building outbound integration feeds.

Every operator is a function from DataFrames (and plain Python parameters) to a
DataFrame. Nothing is collected to the driver except one-row run parameters.
The clock is always passed in through :class:`feedkit.context.RunContext`, so a
run can be repeated exactly.
"""

from feedkit.context import RunContext

__all__ = ["RunContext"]
__version__ = "0.1.0"
