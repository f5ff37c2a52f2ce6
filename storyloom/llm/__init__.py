"""Training-data operators: filters, near-duplicates, tokens and packing.

Nothing outside this subpackage imports it. Each module holds one operator
with its own interface; ``queries`` has the thin registered queries.
"""
