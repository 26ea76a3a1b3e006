"""DataFrame to DataFrame operators: filters, dedupe, joins, rollups."""
