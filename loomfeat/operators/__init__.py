"""DataFrame operators: aggregation, windows, joins, encoders, selection, scoring."""
