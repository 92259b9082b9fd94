"""Training-data operators: mixing, sharding, joins, search, extraction,
archives, classifiers, near-duplicates and packing.

Nothing outside this subpackage imports it; ``__spark_entry__`` registers its
queries only when it is present.
"""
