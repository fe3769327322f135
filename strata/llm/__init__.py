"""Training-data operators: scoring, decontamination, toxicity, substring and
near-duplicate removal, sharding, packing, quality rules, token counts and URL
filters. Nothing else in the library imports this subpackage."""
