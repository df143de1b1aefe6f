"""Training-data operators: scoring, filtering, deduplication, mixing and encoding of text corpora."""
