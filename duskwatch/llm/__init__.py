"""Training-data operators: filters, mixing, deduplication, scoring and archives over text tables."""
