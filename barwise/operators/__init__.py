"""DataFrame operators over bar tables: filters, joins, aggregates, windows,
quality rules and reference data."""
