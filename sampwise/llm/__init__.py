"""Training-data operators: scoring, mixing, packing, deduplication, filtering,
extraction, formatting and search.  Nothing outside this package imports it."""
