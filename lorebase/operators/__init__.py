"""Jobs that take DataFrames and return DataFrames."""
