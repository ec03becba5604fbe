"""Training-data operators: extraction, near-duplicates, filters, tokens, packing.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it is present.
"""
