"""celltrove: relational, expression, spatial and feature operators for cell-level tables, as Spark DataFrames."""
