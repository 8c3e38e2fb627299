"""Operators of a training-data pipeline: scoring, rules, near-duplicates, tokens, mixing, shards."""
