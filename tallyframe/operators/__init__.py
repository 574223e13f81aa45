"""Column rules, statistics, metrics and models over DataFrames."""
