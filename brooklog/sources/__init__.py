"""Change logs and control tables as DataFrames."""
