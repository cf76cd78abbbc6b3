"""Operators of a training-data pipeline: scoring, rules, mixing, tokens, joins, archives."""
