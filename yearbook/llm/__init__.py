"""Training-data operators: privacy, packing, toxicity, token files, quality, sharding,
language, near duplicates, token counts, and benchmark leaks.

Nothing else in the package imports this subpackage.
"""
