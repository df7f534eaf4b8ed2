"""Training-data operators: deduplication, decontamination, scoring, tokenizing and sharding."""
