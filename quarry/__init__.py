"""quarry: analytics operators on Spark DataFrames.

Every public operator takes DataFrames and returns DataFrames; the work is
declared with the DataFrame API so that Catalyst plans it (pushdown, pruning,
partial aggregation) and nothing proportional to the data is collected to the
driver.
"""

__all__ = ["session"]
