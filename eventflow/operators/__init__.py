"""Operators: ordered scans, windows, event time, joins, keyed state, graph ranking."""
