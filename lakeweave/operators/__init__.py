"""DataFrame operators: keyed state, rolling windows, change replay, joins, aggregates, quality."""
