"""DataFrame operators: cleansing, deduplication, keys, joins, quality checks."""
