"""Training-data operators: mixing, near-duplicates, sharding, search, packing, toxicity.

Nothing else in the library imports this subpackage; ``queries`` and ``sql`` hold what the
driver's entry registers.
"""
