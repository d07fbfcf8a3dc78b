"""Column helpers, series windows, recursive averages and exact quantiles."""
