"""DataFrame operators: cleaning, joins, series, splits, profiling, features, models."""
