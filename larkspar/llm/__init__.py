"""Training-data operators: dedup, joins, tokenisation, privacy, scoring, packing.

Nothing outside this subpackage imports it; ``queries`` holds its registered queries.
"""
