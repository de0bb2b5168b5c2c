"""DataFrame operators: take and return DataFrames, column names are arguments."""
