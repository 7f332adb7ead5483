"""Relational operators: dedup, windows, joins, filters, ordering, incremental, quality."""
