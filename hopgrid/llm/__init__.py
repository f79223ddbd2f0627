"""Training-data operators: deduplication, packing, sharding, scoring, extraction."""
