"""Analytics over work items, documents and usage logs, as Spark DataFrames."""
